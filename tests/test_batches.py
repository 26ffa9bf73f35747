import pytest
from pyspark.sql import functions as F

from tessera.operators import batches as BA


def _elements(spark, n=103):
    df = spark.range(n).select(F.col("id").cast("string").alias("patch_id"), F.lit("train").alias("split"))
    return BA.shard(BA.element_order(df, "split", ["patch_id"], n_buckets=8, n_groups_bound=1), 4)


def test_shards_partition_the_sequence(spark):
    e = _elements(spark).collect()
    assert sorted(r["idx"] for r in e) == list(range(103))
    sizes = {}
    for r in e:
        assert r["shard"] == r["idx"] % 4 and r["shard_pos"] == r["idx"] // 4
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + 1
    assert sizes == {0: 26, 1: 26, 2: 26, 3: 25}


def test_shard_guard(spark):
    e = _elements(spark)
    BA.check_shards(e, 4, "split")
    with pytest.raises(ValueError):
        BA.check_shards(e.filter("shard != 3"), 4, "split")


def test_repeat_and_batch(spark):
    r = BA.batch(BA.repeat(_elements(spark), 2, group_cols=("split", "shard")), 8)
    assert r.count() == 2 * 103
    s0 = r.filter("shard = 3").orderBy("pos").collect()
    assert [x["pos"] for x in s0] == list(range(50))
    assert s0[25]["rep"] == 1 and s0[25]["shard_pos"] == 0  # second pass starts after 25 elements
    assert s0[24]["batch_id"] == s0[25]["batch_id"] == 3    # a batch straddles the two repeats
    batches = BA.collect_batches(r, ("split", "shard")).collect()
    assert max(len(b["items"]) for b in batches) == 8
    assert sum(len(b["items"]) for b in batches) == 206


def test_global_batch_size():
    assert BA.global_batch_size(8, 4) == 32


def test_materialize_checkpoint(spark):
    df = spark.range(10)
    assert BA.materialize(df, "checkpoint").count() == 10
    assert BA.materialize(df, "persist").count() == 10
