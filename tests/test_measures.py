"""Soft metrics, selection sampling, salted winners, counters, run tables and the checked forest."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tessera.functions.hashing import hash32
from tessera.operators import funnel as FU
from tessera.operators import labels as L
from tessera.operators import metrics as M
from tessera.operators import models as MO
from tessera.operators import sampling as S
from tessera.operators.transformers import LabelRecoder, PixelExtractor
from tessera.plans import queries as Q
from tessera.plans import runs as RU
from tessera.plans import testbed as TB
from tessera.schemas import EPOCH_HISTORY, STAGE_TIMING
from tessera.sources import sinks as SK


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_soft_iou_ignores_a_class_and_rows_without_probabilities(spark):
    rng = np.random.default_rng(3)
    probs, labels = rng.dirichlet(np.ones(4), 60), rng.integers(0, 4, 60)
    rows = [(int(y), p.tolist()) for y, p in zip(labels, probs)] + [(None, probs[0].tolist()), (2, None)]
    df = spark.createDataFrame(rows, "label int, probability array<double>")
    keep = labels != 3
    inter = np.array([probs[keep & (labels == c), c].sum() for c in range(3)])
    total = np.array([probs[keep, c].sum() + probs[0, c] for c in range(3)])
    union = np.array([(labels == c).sum() for c in range(3)]) + total - inter
    got = {r["class_id"]: r for r in M.soft_iou_per_class(df, ignore_index=3).collect()}
    assert sorted(got) == [0, 1, 2]
    assert all(np.isclose(got[c]["iou"], (inter[c] + 1e-5) / (union[c] + 1e-5)) for c in range(3))
    assert M.soft_jaccard_loss(df, ignore_index=3).first()["n_classes"] == 3
    # vectors are summed per label; nothing is exploded before that
    assert "Generate" not in plan_of(M.soft_confusion(df))
    assert M.soft_confusion(df.filter("false")).count() == 0


def test_hard_iou_ignores_a_class(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 1.0), (2, 0.0), (2, 2.0)], "label int, prediction double")
    got = {r["class_id"]: (r["intersection"], r["union"]) for r in M.iou_per_class(df, ignore_index=2).collect()}
    assert got == {0: (1, 2), 1: (1, 2)}
    assert M.iou_mean(df, num_classes=3, ignore_index=2).first()["n_classes"] == 2
    assert M.jaccard_loss(df, ignore_index=2, smooth=0.0).first()["jaccard_loss"] == 0.5


def test_exact_sample_by_selection_equals_ranking(spark):
    rows = [(f"k{i}", "a" if i % 5 else "b") for i in range(3000)] + [("same", "a")] * 7 + [("lost", None)]
    df = spark.createDataFrame(rows, "k string, s string")
    for f in (0.0, 0.001, 0.37, 1.0, {"a": 0.5}):
        want = []
        for s in ("a", "b"):
            part = sorted((r["h"], r["k"]) for r in df.filter(F.col("s") == s).select("k", hash32("k", seed=9).alias("h")).collect())
            share = f.get(s, 0.0) if isinstance(f, dict) else f
            want += [(k, s) for _, k in part[: round(share * len(part))]]
        got = S.exact_sample(df, "s", f, ["k"], seed=9, n_strata_bound=2)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert S.exact_sample(df.filter("false"), "s", 0.5, ["k"]).count() == 0


def test_exact_sample_ranks_clashing_hashes_by_key(spark, monkeypatch):
    monkeypatch.setattr(S, "hash32", lambda *c, seed: F.pmod(F.col("k"), F.lit(3)).cast("bigint") * 70_000)
    got = S.exact_sample(spark.range(30).select(F.col("id").alias("k"), F.lit("x").alias("s")), "s", 0.5, ["k"], n_strata_bound=1)
    assert sorted(r["k"] for r in got.collect()) == sorted([*range(0, 30, 3), 1, 4, 7, 10, 13])


def test_exact_sample_shuffles_no_row_below_the_cut(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).cast("string").alias("s"), F.lit("payload").alias("wide"))
    below = S.exact_sample(df, "s", 0.5, ["k"], n_strata_bound=2)._jdf.queryExecution().optimizedPlan().children().head()
    assert "Window" not in below.toString().split("Join")[0] and "Filter" in below.toString()
    text = plan_of(S.exact_sample(df, "s", 0.5, ["k"], n_strata_bound=2))
    first_branch = text.split("Union")[1].split("BroadcastExchange")[0]
    assert "Exchange" not in first_branch.replace("BroadcastHashJoin", "")


@pytest.mark.parametrize("bound", [None, 3])
def test_best_epoch_has_no_exchange_of_rows_by_run_alone(spark, bound):
    h = spark.range(2000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("r"), (F.col("id") % 20).cast("string"))).alias("run"),
                                 F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 37) % 500).alias("started"),
                                 F.when(F.col("id") % 7 > 0, ((F.col("id") * 7919) % 1013).cast("double")).alias("loss"))
    h = h.unionByName(spark.createDataFrame([("none", 1, None, None)], h.schema))
    got = {r["run"]: r for r in M.best_epoch_by_time(h, n_runs_bound=bound, salts=8).collect()}
    rows = {}
    for r in h.collect():
        rows.setdefault(r["run"], []).append(r)
    for run, rs in rows.items():
        scored = [r for r in rs if r["loss"] is not None]
        assert got[run]["n_epochs"] == len(rs)
        if not scored:
            assert got[run]["best_epoch"] is None
            continue
        win = min(scored, key=lambda r: (r["loss"], r["started"], r["event_id"]))
        assert got[run]["best_epoch"] == 1 + sum((r["started"], r["event_id"]) < (win["started"], win["event_id"]) for r in rs)
        assert got[run]["best_loss"] == win["loss"]


def test_dictionary_is_broadcast_on_proof_only(spark, tmp_path):
    path = str(tmp_path / "codes.csv")
    with open(path, "w") as f:
        f.write("ID,ID_NEW,DESC\n700,7,x\n111,1,y\n999,9,z\n")
    d = L.read_label_dictionary(spark, path)
    assert [(r["ID"], r["CLASS"]) for r in d.collect()] == [(700, 0), (111, 1), (999, 2)]
    px = spark.createDataFrame([("p", 0, 700), ("p", 1, 111), ("p", 2, 5)], "patch_id string, pos int, label bigint")
    assert sorted(r["label"] for r in LabelRecoder(dictionaryPath=path).transform(px).collect()) == [0, 1]
    assert L.proven_rows(d) is None and L.proven_rows(L.label_dictionary(spark)) == 45
    assert "strategy=broadcast" not in L.recode_labels(px, d)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in L.recode_labels(px, L.label_dictionary(spark))._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError):
        L.recode_labels(px, spark.range(20_000).select(F.col("id").alias("ID"), F.col("id").alias("ID_NEW")).limit(15_000))


def test_counts_and_both_accuracies(spark):
    meta = TB.metadata(spark, SF001).select("patch_id", "split")
    tiles = TB.band_tiles(spark, SF001)
    model = MO.fit(MO.build_pipeline(PixelExtractor().with_tiles(tiles), num_trees=2, max_depth=2), meta.filter("split = 'train'"))
    test = meta.filter("split = 'test'")
    found = FU.evaluate_both(model, test)
    want = {r["split"]: r for r in Q.q_pixel_counts(spark, SF001).collect()}["test"]
    assert (found["n_pixels"], found["n_known"], found["n_valid"]) == (want["n_pixels"], want["n_known"], want["n_valid"])
    assert found["n_pixels"] > found["n_known"] >= found["n_valid"] > 0
    assert found["accuracy"] == found["n_correct"] / found["n_valid"] > found["accuracy_all"] == found["n_correct"] / found["n_pixels"]
    assert np.isclose(found["accuracy"], MO.evaluate_accuracy(MO.predict(model, test)))


def test_run_tables_are_rewritten_by_run(spark, tmp_path):
    log = RU.EpochLog("a")
    for loss in (0.9, 0.4):
        with log.epoch(loss=loss) as found:
            found["val_loss"] = loss + 0.1
    with pytest.raises(ZeroDivisionError):
        with log.epoch():
            1 / 0
    path = str(tmp_path / "epochs")
    other = spark.createDataFrame([("b", 1, 0.5, None, None, None, 1.0)], EPOCH_HISTORY)
    SK.write_runs(other, path, EPOCH_HISTORY)
    for _ in range(2):  # a retry
        SK.write_runs(log.frame(spark), path, EPOCH_HISTORY)
    back = SK.read_runs(spark, path, EPOCH_HISTORY)
    assert back.schema == EPOCH_HISTORY and sorted((r["run"], r["epoch"], r["loss"]) for r in back.collect()) == [("a", 1, 0.9), ("a", 2, 0.4), ("b", 1, 0.5)]
    assert all(r["epoch_duration"] >= 0 for r in back.collect())
    best = {r["run"]: r["best_epoch"] for r in M.best_epoch(back).collect()}
    assert best == {"a": 2, "b": 1}
    with pytest.raises(ValueError):
        SK.write_runs(log.frame(spark), str(tmp_path / "stages"), STAGE_TIMING)
    timer = RU.StageTimer("a")
    with timer.stage("fit"):
        pass
    SK.write_runs(timer.frame(spark), str(tmp_path / "stages"), STAGE_TIMING)
    assert os.listdir(str(tmp_path / "stages")).count("run=a") == 1


def test_forest_is_the_same_under_any_layout(spark):
    px = Q.pixels(spark, SF001).withColumn("label", F.when(F.col("R") < 2000, 111).otherwise(112).cast("bigint"))
    one = MO.fit(MO.pixel_pipeline(num_trees=3, max_depth=3), px.repartition(5), layout=4).stages[-1].toDebugString
    two = MO.fit(MO.pixel_pipeline(num_trees=3, max_depth=3), px.repartition(2, "pos"), layout=4).stages[-1].toDebugString
    assert one.split("\n", 1)[1] == two.split("\n", 1)[1]


def test_tiles_in_memory_are_not_saved(spark, tmp_path):
    held = PixelExtractor().with_tiles(TB.band_tiles(spark, SF001))
    with pytest.raises(ValueError):
        held.save(str(tmp_path / "x"))
    PixelExtractor(tilesPath="somewhere").save(str(tmp_path / "y"))


def test_filter_is_pushed_into_the_scan(spark):
    plan = plan_of(Q.q_scan_pushed(spark, SF001))
    assert "PushedFilters: [In(o_orderstatus, [F,O])]" in plan and "o_orderdate" not in plan
