"""Distributed, deterministic global row index within groups.

``idx`` = 0-based rank of a row inside its group under a total order.
Written naively as ``row_number() OVER (PARTITION BY g ORDER BY o)`` every
group lands in one task; with a group holding a third of all rows that
task is the job. Instead:

1. every row gets a *bucket* that is monotone in the order key: the top
   bits of a uniform hash (hash order), or an equal-width slice of the
   group's [min, max] range (time order). Buckets split hot groups;
2. counts per (group, bucket) form a small table (<= groups x buckets
   rows); a window over it gives each bucket's starting offset;
3. ``row_number`` runs per (group, bucket), i.e. in many small window
   partitions spread over all tasks, and the offset is added back by a
   join with the small table: broadcast when the caller proves the group
   count (``n_groups_bound``), else left to AQE's measured sizes. Without a
   broadcast the join is still cheap: the ranked side is already hash
   partitioned and sorted on (group, bucket), so only the small side moves.

Everything is a pure function of the data (no sampling, no partition ids),
so a re-run after executor loss yields identical indices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.common import epoch_micros
from tessera.functions.hashing import hash_bucket

# Offsets table is broadcast only up to this many rows (groups x buckets).
MAX_OFFSET_ROWS = 2_000_000


def default_buckets(spark, floor: int = 1024, per_partition: int = 4) -> int:
    """Buckets per group: enough (group, bucket) window partitions to fill
    every shuffle partition several times over, never fewer than ``floor``.
    On a large cluster (tens of thousands of shuffle partitions) a hot group
    is then ranked by as many tasks as any other stage."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(floor, per_partition * parts)


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def with_global_index(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                      bucket: Column, n_buckets: int, out: str = "idx",
                      n_groups_bound: int | None = None, total_out: str | None = None) -> DataFrame:
    """Append ``out`` = 0-based position of the row within its group when
    sorted by ``order_cols`` (which must be a total order, ties broken by
    a unique key). ``bucket`` must be non-decreasing in that order and lie
    in [0, n_buckets). With ``total_out`` the group's row count is added
    too, read off the same small table (no extra pass over the data)."""
    g = list(group_cols)
    b = df.withColumn("_bkt", bucket)
    counts = b.groupBy(*g, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*g).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("_n").over(Window.partitionBy(*g)).alias(total_out)] if total_out else []
    offsets = counts.select(*g, "_bkt", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"), *extra)
    bound = (n_groups_bound or 1) * n_buckets
    if n_groups_bound is not None and bound <= MAX_OFFSET_ROWS:
        offsets = F.broadcast(offsets)
    w_local = Window.partitionBy(*g, "_bkt").orderBy(*_cols(order_cols))
    ranked = b.withColumn("_rn", F.row_number().over(w_local))
    return (ranked.join(offsets, [*g, "_bkt"], "inner")
            .withColumn(out, (F.col("_off") + F.col("_rn") - 1).cast("bigint"))
            .drop("_bkt", "_rn", "_off"))


def hash_order_index(df: DataFrame, group_cols: Sequence[str], hash_col: str, key_cols: Sequence[str],
                     n_buckets: int, out: str = "idx", n_groups_bound: int | None = None,
                     total_out: str | None = None) -> DataFrame:
    """Global index in (hash, key) order; buckets are the hash's top bits."""
    return with_global_index(df, group_cols, [hash_col, *key_cols],
                             hash_bucket(F.col(hash_col), n_buckets), n_buckets, out, n_groups_bound,
                             total_out)


def time_order_index(df: DataFrame, group_cols: Sequence[str], time_col: str, key_cols: Sequence[str],
                     n_buckets: int, out: str = "idx", n_groups_bound: int | None = None) -> DataFrame:
    """Global index in (time, key) order; buckets are equal-width slices of
    each group's [min, max] time range (exact min/max per group, so the
    bucket of a row is deterministic).

    Balance follows the spread of the timestamps: rows sharing one exact
    timestamp stay in one bucket, so a single instant carrying a large share
    of a group is ranked by one (spilling) task. Hash order
    (:func:`hash_order_index`) has no such limit, and
    :func:`range_order_index` handles any order with any skew, at the cost
    of one checkpoint of the key columns. To pick a best epoch, use
    :func:`tessera.operators.metrics.best_epoch_by_time`, which needs no
    index at all."""
    g = list(group_cols)
    t = epoch_micros(df, time_col)
    rng = df.groupBy(*g).agg(F.min(t).alias("_tmin"), F.max(t).alias("_tmax"))
    if n_groups_bound is not None and n_groups_bound <= MAX_OFFSET_ROWS:
        rng = F.broadcast(rng)
    span = F.greatest(F.col("_tmax") - F.col("_tmin"), F.lit(1))
    # floor((t - min) * n / (span + 1)) in exact decimal arithmetic.
    num = (t - F.col("_tmin")).cast("decimal(38,0)") * F.lit(n_buckets).cast("decimal(38,0)")
    bkt = F.floor(num / (span + 1).cast("decimal(38,0)")).cast("int")
    with_rng = df.join(rng, g, "inner")
    res = with_global_index(with_rng, g, [time_col, *key_cols], bkt, n_buckets, out, n_groups_bound)
    return res.drop("_tmin", "_tmax")


def range_order_index(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                      out: str = "idx", n_partitions: int | None = None,
                      n_groups_bound: int | None = None) -> DataFrame:
    """Global index for any total order, whatever its skew.

    Sampled range partitioning on (group, order...) splits every group,
    and even a single hot timestamp, across partitions, because the order
    includes a unique tiebreak. The ranged rows (only the columns of ``df``)
    are checkpointed into the session's shared checkpoint folder, so the
    partition contents, and with them the in-partition positions, are
    fixed before the offsets are derived. Recomputation cannot shift them.
    Offsets come from a table of at most partitions + groups rows.
    """
    from tessera.session import ensure_checkpoint_dir

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    g = list(group_cols)
    keys = [*g, *order_cols]
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    stats = ranged.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select("_pid", *g, "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if n_groups_bound is not None and n + n_groups_bound <= MAX_OFFSET_ROWS:
        offs = F.broadcast(offs)
    return (ranged.join(offs, ["_pid", *g], "inner")
            .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("bigint"))
            .drop("_pid", "_mid", "_first", "_off"))
