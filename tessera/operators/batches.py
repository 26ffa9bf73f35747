"""Training-set preparation: shard, repeat, batch.

The element order of a split is the layout-independent hash order of the
sampler, numbered by the distributed global index. Then, per worker shard:
``shard = idx mod n``; the shard's sequence is repeated k times
(``pos = rep * N_shard + idx div n``) and cut into consecutive batches of B
(``batch_id = pos div B``); the last batch may be partial and a batch may
straddle two repeats, since repetition precedes batching.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.common import idiv
from tessera.functions.hashing import hash32
from tessera.operators.indexing import hash_order_index


def element_order(df: DataFrame, group_col: str, key_cols: Sequence[str], seed: int = 42,
                  n_buckets: int = 1024, n_groups_bound: int | None = None) -> DataFrame:
    """Add ``idx``: 0-based position within ``group_col`` in hash order, and
    ``n_group``: the group's size."""
    hashed = df.withColumn("_h", hash32(*key_cols, seed=seed))
    return hash_order_index(hashed, [group_col], "_h", list(key_cols), n_buckets, "idx",
                            n_groups_bound, total_out="n_group").drop("_h")


def shard(df: DataFrame, n_shards: int, idx_col: str = "idx", total_col: str = "n_group") -> DataFrame:
    """``shard = idx mod n``, ``shard_pos = idx div n`` (position inside the
    worker's shard) and, when the group size is known, ``shard_size`` =
    ceil((N - shard) / n), the number of elements the worker holds."""
    out = df.withColumn("shard", F.pmod(F.col(idx_col), F.lit(n_shards)).cast("int")) \
        .withColumn("shard_pos", idiv(idx_col, n_shards))
    if total_col in df.columns:
        out = out.withColumn("shard_size", idiv(F.col(total_col) - F.col("shard") + (n_shards - 1), n_shards))
    return out


def check_shards(df: DataFrame, n_shards: int, group_col: str | None = None) -> None:
    """Worker-count guard (action): every group must populate all n shards
    when it has at least n elements. Raises ``ValueError`` otherwise."""
    keys = [group_col] if group_col else []
    stats = (df.groupBy(*keys).agg(F.count_distinct("shard").alias("s"), F.count(F.lit(1)).alias("n"))
             .filter((F.col("s") != F.least(F.col("n"), F.lit(n_shards)))))
    bad = stats.limit(5).collect()
    if bad:
        raise ValueError(f"expected {n_shards} shards, got {[r.asDict() for r in bad]}")


def repeat(df: DataFrame, k: int, group_cols: Sequence[str] = ("shard",),
           pos_col: str = "shard_pos", size_col: str = "shard_size",
           n_groups_bound: int | None = None) -> DataFrame:
    """Repeat every element k times: ``rep`` in [0, k) and
    ``pos = rep * N_group + pos_col`` (position in the repeated sequence).
    N per group is ``size_col`` when present (narrow, no shuffle), else one
    small aggregation broadcast back."""
    g = list(group_cols)
    if size_col in df.columns:
        src, n = df, F.col(size_col)
    else:
        sizes = df.groupBy(*g).agg(F.count(F.lit(1)).alias("_N"))
        if n_groups_bound is not None:
            sizes = F.broadcast(sizes)
        src, n = df.join(sizes, g, "inner"), F.col("_N")
    return (src.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            .withColumn("pos", F.col("rep").cast("bigint") * n + F.col(pos_col))
            .drop("_N"))


def batch(df: DataFrame, batch_size: int, pos_col: str = "pos") -> DataFrame:
    """``batch_id = pos div B`` and ``slot = pos mod B``; the last batch may
    be partial."""
    return df.withColumn("batch_id", idiv(pos_col, batch_size)) \
        .withColumn("slot", F.pmod(F.col(pos_col), F.lit(batch_size)).cast("int"))


def collect_batches(df: DataFrame, group_cols: Sequence[str] = ("shard",),
                    value_cols: Sequence[str] = ("patch_id",)) -> DataFrame:
    """One row per batch with its elements in slot order; every group holds
    at most B elements, so the collected arrays are bounded."""
    g = list(group_cols)
    items = F.array_sort(F.collect_list(F.struct("slot", *value_cols)))
    return df.groupBy(*g, "batch_id").agg(items.alias("items"))


def global_batch_size(local_batch_size: int, n_workers: int) -> int:
    return local_batch_size * n_workers


def materialize(df: DataFrame, how: str = "persist") -> DataFrame:
    """Reuse decoded data across passes. ``persist``: memory and disk,
    recomputed from lineage if an executor is lost; ``checkpoint``: written
    to the session's shared checkpoint folder, cutting the lineage."""
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        from tessera.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)  # the cluster's shared folder
        return df.checkpoint(eager=True)
    raise ValueError(how)
