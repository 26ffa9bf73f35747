import math

from tessera.operators import metrics as M
from conftest import rows


def _preds(spark):
    data = [(1, 1.0)] * 6 + [(1, 0.0)] * 2 + [(0, 0.0)] * 3 + [(0, 1.0)] * 1 + [(2, 2.0)]
    return spark.createDataFrame(data, "label bigint, prediction double")


def test_confusion_and_accuracy(spark):
    cm = sorted(rows(M.confusion(_preds(spark)), "label", "prediction", "n"))
    assert cm == [(0, 0, 3), (0, 1, 1), (1, 0, 2), (1, 1, 6), (2, 2, 1)]
    a = M.accuracy(_preds(spark)).collect()[0]
    assert (a["n"], a["n_correct"]) == (13, 10) and math.isclose(a["accuracy"], 10 / 13)


def test_accuracy_empty(spark):
    a = M.accuracy(_preds(spark).filter("false")).collect()[0]
    assert a["n"] == 0 and a["accuracy"] is None


def test_iou_and_jaccard(spark):
    per = {r["class_id"]: r for r in M.iou_per_class(_preds(spark), smooth=0.0).collect()}
    assert math.isclose(per[1]["iou"], 6 / 9) and math.isclose(per[0]["iou"], 3 / 6) and per[2]["iou"] == 1.0
    m = M.iou_mean(_preds(spark), smooth=0.0).collect()[0]["iou_score"]
    assert math.isclose(m, (6 / 9 + 3 / 6 + 1) / 3)
    j = M.jaccard_loss(_preds(spark), smooth=0.0).collect()[0]["jaccard_loss"]
    assert math.isclose(j, 1 - m) and 0 <= m <= 1


def test_iou_with_declared_classes(spark):
    per = M.iou_per_class(_preds(spark), num_classes=4)
    assert per.count() == 4 and per.filter("class_id = 3").collect()[0]["iou"] == 1.0


def test_best_epoch_tie_takes_earliest(spark):
    h = spark.createDataFrame([("r", 1, 0.5), ("r", 2, 0.3), ("r", 3, 0.3), ("s", 1, None), ("s", 2, 0.9)],
                              "run string, epoch int, loss double")
    out = {r["run"]: r for r in M.best_epoch(h).collect()}
    assert (out["r"]["best_epoch"], out["r"]["best_loss"], out["r"]["n_epochs"]) == (2, 0.3, 3)
    assert out["s"]["best_epoch"] == 2


def test_split_counts(spark):
    df = spark.createDataFrame([("train",), ("train",), ("test",)], "split string")
    assert sorted(rows(M.split_counts(df))) == [("test", 1), ("train", 2)]


def test_best_epoch_by_time_matches_numbered(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    h = spark.range(500).select(
        (F.col("id") % 3).cast("string").alias("run"), F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 37) % 200).alias("started"),
        ((F.col("id") * 7919) % 13).cast("double").alias("loss"))
    numbered = h.withColumn("epoch", F.row_number().over(Window.partitionBy("run").orderBy("started", "event_id")))
    a = sorted(tuple(r) for r in M.best_epoch(numbered).collect())
    b = sorted(tuple(r) for r in M.best_epoch_by_time(h, n_runs_bound=3).collect())
    assert a == b


def test_soft_iou_matches_numpy(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(1)
    probs = rng.dirichlet(np.ones(3), size=50)
    labels = rng.integers(0, 3, size=50)
    rows = [(int(l), Vectors.dense(p.tolist())) for l, p in zip(labels, probs)]
    df = spark.createDataFrame(rows, ["label", "probability"])
    s = 1e-5
    onehot = np.eye(3)[labels]
    inter = (onehot * probs).sum(0)
    union = onehot.sum(0) + probs.sum(0) - inter
    exp = (inter + s) / (union + s)
    got = {r["class_id"]: r["iou"] for r in M.soft_iou_per_class(df).collect()}
    assert all(math.isclose(got[c], exp[c], rel_tol=1e-9) for c in range(3))
    j = M.soft_jaccard_loss(df).collect()[0]
    assert math.isclose(j["jaccard_loss"], 1 - exp.mean(), rel_tol=1e-9)
    # one-hot probabilities reduce to the hard IoU
    hard = spark.createDataFrame([(int(l), float(l)) for l in labels], "label bigint, prediction double")
    oh = spark.createDataFrame([(int(l), Vectors.dense(np.eye(3)[l].tolist())) for l in labels],
                               ["label", "probability"])
    h = {r["class_id"]: r["iou"] for r in M.iou_per_class(hard).collect()}
    o = {r["class_id"]: r["iou"] for r in M.soft_iou_per_class(oh).collect()}
    assert all(math.isclose(h[c], o[c]) for c in h)
