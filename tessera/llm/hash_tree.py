"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree region -> rack -> shard. For a row every leaf draws
``-ln(u) / weight``, with ``u`` a hash of the row's key and the leaf's name. The draw of a
rack or region is the least of its leaves' draws, which is again a weighted draw, with
the sum of their weights. The row descends to the region, then the rack, then the
shard of least draw, so each is chosen in proportion to its weight. A draw depends on its own subtree alone: when
weights change, rows move only into leaves whose weight grew or out of those
whose weight fell, and other subtrees keep theirs. One more shard, wherever it is placed and whatever the
count, takes rows only into itself.

``assign_shards`` keeps the law ``key``: id and shard count alone decide.
Slots number the rows of a shard from 0 without gaps. Equal rows are counted
first and numbered together; a shard's rows are ranked in hash buckets whose
counts (at most shards x buckets rows, broadcast) give the offsets, so no task
holds a whole shard.

Defined cases: a NULL id is a key of its own; a NULL text has size 16 and
crc32 0; repeated rows share a shard and have slots of their own; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 40
SHARDS_PER_RACK = 4
SHARDS_PER_REGION = 8
ROW_OVERHEAD = 16
SLOT_BUCKETS = 512
# 13 hex digits of an MD5 as a number in (0, 1).
HASH_SPAN = float(2**52)

def _digits(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 13), 16, 10)


def _draw(key: Column, leaf: Column, weight: Column) -> Column:
    u = (_digits(F.concat(key, F.lit("/shard/"), leaf.cast("string"))).cast("double") + 0.5) / F.lit(HASH_SPAN)
    return -F.log(u) / weight


def leaf_draws(key: Column, weights: Sequence[float]) -> Column:
    """Array of (draw, shard) of the shards with positive weight; others get no rows."""
    leaves = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights) if w > 0])
    return F.transform(leaves, lambda c: F.struct(_draw(key, c["id"], c["weight"]).alias("draw"), c["id"].alias("shard")))


def descend(draws: Column, per_rack: int = SHARDS_PER_RACK, per_region: int = SHARDS_PER_REGION) -> tuple[Column, Column, Column]:
    """(region, rack, shard) by the least draw on each level. The region of
    least draw holds the leaf of least draw, and so does its rack; shards are numbered in layout order."""
    shard = F.array_min(draws)["shard"]
    return F.floor(shard / per_region).cast("int"), F.floor(shard / per_rack).cast("int"), shard


def assign_shards(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                  weights: Sequence[float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, region, rack, shard, slot, grown_shard
    (the shard under one more shard of weight 1)."""
    weights = list(weights or [1.0] * n_shards)
    if len(weights) != n_shards or max(weights) <= 0:
        raise ValueError("one weight for each shard, and one at least above 0")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = rows.withColumn("draws", leaf_draws(key, [*weights, 1.0]))
    region, rack, shard = descend(F.filter("draws", lambda d: d["shard"] < n_shards))
    rows = rows.select("doc_id", "size", "text_crc32", "copies", region.alias("region"), rack.alias("rack"), shard.alias("shard"),
                       descend(F.col("draws"))[2].alias("grown_shard"),
                       F.pmod(_digits(F.concat(key, F.lit("/slot"))).cast("long"), F.lit(SLOT_BUCKETS)).cast("int").alias("bucket"))
    counts = rows.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    rows = rows.join(F.broadcast(offsets), ["shard", "bucket"])
    first = F.col("offset") + F.col("ahead")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "region", "rack", "shard",
                       F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("slot"), "grown_shard")
