from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.operators import indexing as IX
from tessera.operators import sampling as S
from tessera.functions.hashing import hash32


def _frame(spark, n=3000):
    # a skewed stratum column: 'train' holds ~2/3 of the rows
    return spark.range(n).select(F.col("id").cast("string").alias("key"),
                                 F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split"))


def _keys(df):
    return sorted(r[0] for r in df.select("key").collect())


def test_stratified_sample_is_layout_independent(spark):
    base = _frame(spark)
    fr = {"train": 0.2, "test": 0.5}
    samples = [_keys(S.stratified_sample(base.repartition(n), "split", fr, ["key"])) for n in (1, 4, 8)]
    assert samples[0] == samples[1] == samples[2]
    n_test = S.stratified_sample(base, "split", fr, ["key"]).filter("split = 'test'").count()
    assert 400 < n_test < 600


def test_absent_stratum_gets_zero(spark):
    out = S.stratified_sample(_frame(spark), "split", {"train": 1.0}, ["key"])
    assert out.filter("split = 'test'").count() == 0 and out.count() == 2000


def test_exact_sample_size_and_layout(spark):
    base = _frame(spark)
    a = S.exact_sample(base.repartition(1), "split", 0.25, ["key"], n_buckets=16)
    b = S.exact_sample(base.repartition(7), "split", 0.25, ["key"], n_buckets=64)
    assert _keys(a) == _keys(b)
    counts = {r[0]: r[1] for r in a.groupBy("split").count().collect()}
    assert counts == {"train": 500, "test": 250}


def test_exact_sample_half_even(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("key"), F.lit("s").alias("split"))
    assert S.exact_sample(df, "split", 0.25, ["key"]).count() == 2  # 2.5 -> 2


def test_limit_k_plan(spark):
    df = _frame(spark)
    out = S.limit_k(df, 5, ["key"])
    assert [r[0] for r in out.collect()] == sorted(r[0] for r in df.select("key").collect())[:5]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_filter_isin_pushdown(spark, tmp_path):
    p = str(tmp_path / "meta")
    _frame(spark).write.parquet(p)
    df = S.filter_isin(spark.read.parquet(p), "split", ["train", "test"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(split" in plan


def test_global_index_matches_row_number_under_skew(spark):
    # one group holds ~90% of rows; bucketed index must equal a plain row_number
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"))
    hashed = df.withColumn("h", hash32("id"))
    got = IX.hash_order_index(hashed, ["g"], "h", ["id"], n_buckets=32, n_groups_bound=2)
    brute = hashed.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")) - 1)
    j = got.join(brute, ["id", "g"])
    assert j.count() == 5000 and j.filter(F.col("idx") != F.col("rn")).count() == 0


def test_time_index_matches_row_number(spark):
    df = spark.range(2000).select(
        F.col("id"), (F.col("id") % 3).cast("string").alias("g"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 7919) % 86400).alias("ts"))
    got = IX.time_order_index(df, ["g"], "ts", ["id"], n_buckets=16, n_groups_bound=3)
    brute = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("ts", "id")) - 1)
    j = got.join(brute, ["id", "g"])
    assert j.count() == 2000 and j.filter(F.col("idx") != F.col("rn")).count() == 0


def test_global_index_avoids_single_partition(spark):
    # a single hot group (every row); the key is data, not a foldable literal
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") < 0, "x").otherwise("g").alias("g")) \
        .withColumn("h", hash32("id"))
    plan = IX.hash_order_index(df, ["g"], "h", ["id"], 8, n_groups_bound=1)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "SinglePartition" not in plan


def test_split_frames_and_parity_sampler(spark):
    df = _frame(spark, 300)
    parts = S.split_frames(df, "split", ["train", "test"])
    assert parts["train"].count() == 200 and parts["test"].count() == 100
    s = S.stratified_sample_parity(df, "split", {"train": 0.5}, seed=42)
    assert s.filter("split = 'test'").count() == 0 and 0 < s.count() < 200


def test_range_index_with_hot_timestamp(spark):
    # a third of the rows share one exact timestamp: range partitioning on
    # (group, ts, id) still splits them; result equals a plain row_number
    df = spark.range(3000).select(
        F.col("id"), (F.col("id") % 2).cast("string").alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(1_700_000_000))
        .otherwise(F.lit(1_700_000_000) + F.col("id") % 500).cast("timestamp").alias("ts"))
    got = IX.range_order_index(df, ["g"], ["ts", "id"], n_partitions=7, n_groups_bound=2)
    brute = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("ts", "id")) - 1)
    j = got.join(brute, ["id", "g"])
    assert j.count() == 3000 and j.filter(F.col("idx") != F.col("rn")).count() == 0
    # and it does not depend on the number of range partitions
    other = IX.range_order_index(df, ["g"], ["ts", "id"], n_partitions=3)
    assert sorted(tuple(r) for r in got.select("id", "idx").collect()) == \
        sorted(tuple(r) for r in other.select("id", "idx").collect())


def test_hash_bucket_monotone_and_balanced(spark):
    from tessera.functions.hashing import HASH_SPACE, hash_bucket
    edges = spark.createDataFrame([(0,), (1,), (HASH_SPACE // 2,), (HASH_SPACE - 1,)], "h bigint")
    for n in (1, 7, 1024, 65536):
        b = [r[0] for r in edges.orderBy("h").select(hash_bucket(F.col("h"), n)).collect()]
        assert b == sorted(b) and b[0] == 0 and b[-1] == n - 1
    df = spark.range(20000).select(hash32("id").alias("h"))
    counts = [r[1] for r in df.groupBy(hash_bucket(F.col("h"), 16).alias("b")).count().collect()]
    assert len(counts) == 16 and max(counts) < 1.2 * 20000 / 16
