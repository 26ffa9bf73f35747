"""Filters, stratified / exact-size sampling and deterministic row limits.

Samplers here are *layout independent*: whether a row is kept depends only
on its key, the seed and the fraction, never on how the input was split
into files, partitions or tasks. ``sampleBy`` is kept for parity only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import HASH_SPACE, hash32
from tessera.operators.indexing import MAX_OFFSET_ROWS


def filter_isin(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Membership filter; on a Parquet scan Catalyst pushes it as ``In``."""
    return df.filter(F.col(col).isin(list(values)))


def split_frames(df: DataFrame, col: str, values: Sequence[str]) -> dict[str, DataFrame]:
    """Fan one frame out into one lazily-filtered frame per value."""
    return {v: df.filter(F.col(col) == v) for v in values}


def _fraction_of(strata_col: str, fractions: Mapping[str, float]) -> Column:
    expr = None
    for value, frac in fractions.items():
        if not 0.0 <= frac <= 1.0:
            raise ValueError(f"fraction for {value!r} must be in [0, 1]")
        cond = F.col(strata_col) == F.lit(value)
        expr = F.when(cond, F.lit(float(frac))) if expr is None else expr.when(cond, F.lit(float(frac)))
    return F.lit(0.0) if expr is None else expr.otherwise(F.lit(0.0))


def stratified_sample(df: DataFrame, strata_col: str, fractions: Mapping[str, float],
                      key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Bernoulli sample per stratum: keep a row when
    hash32(seed, key) < fraction * 2^32. A stratum absent from
    ``fractions`` has fraction 0. Narrow: no shuffle, filter only."""
    h = hash32(*key_cols, seed=seed)
    return df.filter(h < _fraction_of(strata_col, fractions) * F.lit(float(HASH_SPACE)))


def stratified_sample_parity(df: DataFrame, strata_col: str, fractions: Mapping[str, float],
                             seed: int = 42) -> DataFrame:
    """Spark's own ``sampleBy`` (depends on the partition layout)."""
    return df.sampleBy(strata_col, dict(fractions), seed)


HALF = 1 << 16  # a 32-bit hash is looked at in two halves


def _cut(counts: DataFrame, strata_col: str, part: str, need: Column) -> DataFrame:
    """Per stratum the value of ``part`` in which the running count reaches
    ``need``, and how many rows are still wanted from it."""
    w = Window.partitionBy(strata_col)
    run = counts.withColumn("_cum", F.sum("_n").over(w.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)))
    run = run.withColumn("_want", need)
    hit = (F.col("_cum") >= F.col("_want")) & (F.col("_cum") - F.col("_n") < F.col("_want"))
    return run.filter(hit).withColumn("_need", F.col("_want") - (F.col("_cum") - F.col("_n")))


def exact_sample(df: DataFrame, strata_col: str, fraction: float | Mapping[str, float],
                 key_cols: Sequence[str], seed: int = 42, n_buckets: int = 1024,
                 n_strata_bound: int | None = None) -> DataFrame:
    """Without-replacement sample of exactly n = round_half_even(f * N) rows
    per stratum: the n rows with the smallest (hash32(seed, key), key).

    Found by selection, not by ranking: counts per (stratum, upper half of the hash)
    give the half in which the n-th row lies, counts of the lower halves there
    its exact hash value. Rows below that value are kept by a filter and are never
    shuffled; only the rows that have just that hash (one, or a few that clash) are ranked by key.
    Both count tables have at most 2^16 rows a stratum. Pass ``n_strata_bound`` only when the
    plan proves it (e.g. after an ``isin`` filter): the cuts, one row a stratum, are then broadcast;
    otherwise AQE sizes them at run time. ``fraction=None``-style "take all" is
    ``fraction=1.0``. ``n_buckets`` is no longer used.
    """
    fractions = fraction if isinstance(fraction, Mapping) else None
    f = _fraction_of(strata_col, fractions) if fractions is not None else F.lit(float(fraction))
    small = F.broadcast if n_strata_bound is not None and n_strata_bound <= MAX_OFFSET_ROWS else (lambda d: d)
    hashed = df.withColumn("_h", hash32(*key_cols, seed=seed))
    upper, lower = F.shiftright("_h", 16), F.col("_h").bitwiseAND(HALF - 1)

    counts = hashed.groupBy(strata_col, upper.alias("_up")).agg(F.count(F.lit(1)).alias("_n"))
    want = F.bround(F.sum("_n").over(Window.partitionBy(strata_col)) * f, 0).cast("bigint")
    first = _cut(counts, strata_col, "_up", want).select(strata_col, F.col("_up").alias("_cut_up"), F.col("_need").alias("_left"))
    inside = hashed.select(strata_col, "_h").join(small(first), strata_col).filter(upper == F.col("_cut_up"))
    counts = inside.groupBy(strata_col, "_cut_up", "_left", lower.alias("_low")).agg(F.count(F.lit(1)).alias("_n"))
    cut = _cut(counts, strata_col, "_low", F.col("_left")).select(
        strata_col, (F.shiftleft("_cut_up", 16) + F.col("_low")).alias("_cut"), F.col("_need").alias("_take"))

    met = hashed.join(small(cut), strata_col)
    below = met.filter(F.col("_h") < F.col("_cut")).select(*df.columns)
    edge = met.filter(F.col("_h") == F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy(strata_col).orderBy(*key_cols))
    return below.unionByName(edge.withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_take")).select(*df.columns))


def limit_k(df: DataFrame, k: int, order_cols: Sequence[str]) -> DataFrame:
    """First k rows under a total order: planned as TakeOrderedAndProject
    (per-partition top-k, then a k-row merge), never a full sort."""
    return df.orderBy(*order_cols).limit(k)
