import os

from pyspark.sql import functions as F

from tessera.operators import tiles as TL
from tessera.plans import testbed as TB
from tessera.plans import workflows as W
from conftest import SF001


def _inputs(spark):
    return TB.metadata(spark, SF001), TB.band_tiles(spark, SF001)


def test_classify_pixels(spark):
    meta, tiles = _inputs(spark)
    res = W.classify_pixels(meta, tiles, fraction=1.0, num_trees=3, max_depth=3)
    assert res.train_patches > res.test_patches > 0 and 0.0 <= res.accuracy <= 1.0
    assert [r[1] for r in res.timer.rows] == ["count", "fit", "evaluation"]
    half = W.classify_pixels(meta, tiles, fraction={"train": 0.5, "test": 0.5}, num_trees=2, max_depth=2)
    assert half.train_patches < res.train_patches


def test_materialize_patches(spark, tmp_path):
    meta, tiles = _inputs(spark)
    out = str(tmp_path / "patches")
    df = W.materialize_patches(meta, tiles, 8, 8, out)
    back = spark.read.parquet(out)
    assert sorted(os.listdir(out))[-2:] == ["split=test", "split=train"]
    assert back.count() == df.count() > 0
    r = back.filter(F.size("missing_bands") == 0).first()
    a = TL.decode_stack(r["bands"], r["dtype"], 6, 8, 8)
    assert a.shape == (6, 1, 8, 8) and len(r["label_map"]) == 64 * 8


def test_prepare_training_set(spark):
    meta, tiles = _inputs(spark)
    ts = W.prepare_training_set(meta, tiles, 8, 12, n_workers=2, local_batch_size=4, repeats=2)
    rows = ts.collect()
    done = [r for r in rows if r["complete"]]
    assert done and all(len(r["image"]) == 12 * 12 * 6 and len(r["label"]) == 144 for r in done)
    assert {r["patch_id"] for r in rows if not r["complete"]} <= {r["patch_id"] for r in rows if r["image"] is None}
    # every patch appears once per repeat; batches hold at most local x workers
    per = {}
    for r in rows:
        per.setdefault(r["patch_id"], set()).add(r["rep"])
    assert all(v == {0, 1} for v in per.values())
    sizes = {}
    for r in rows:
        k = (r["split"], r["shard"], r["batch_id"])
        sizes[k] = sizes.get(k, 0) + 1
    assert max(sizes.values()) <= 8


def test_training_set_engines_agree(spark):
    meta, tiles = _inputs(spark)
    kw = dict(n_workers=2, local_batch_size=4, repeats=1)
    a = W.prepare_training_set(meta, tiles, 8, 12, resize_engine="native", **kw)
    b = W.prepare_training_set(meta, tiles, 8, 12, resize_engine="arrow", **kw)
    ra = sorted((r["patch_id"], r["image"], r["label"]) for r in a.collect())
    rb = sorted((r["patch_id"], r["image"], r["label"]) for r in b.collect())
    assert ra == rb and len(ra) > 0


def test_worker_guard(spark):
    meta, tiles = _inputs(spark)
    W.prepare_training_set(meta, tiles, 8, 12, n_workers=2, local_batch_size=4, check_workers=True)
