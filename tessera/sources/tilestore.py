"""Tables laid out for what reads them: tiles bucketed by patch, shard files in order.

A tile store is a table bucketed and sorted by the patch key. Joins and
per-patch assembly on that key need no exchange, however often they run. The
elements of a training set stored with the same buckets join it without one too.
Shard files are the samples of a worker, in the order it reads them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_store(df: DataFrame, table: str, buckets: int, key: str = "patch_id", order: Sequence[str] = ()) -> None:
    """Write ``df`` as the table ``table``, bucketed by ``key`` and sorted by
    ``key`` and ``order`` within buckets; each bucket is one file (overwrite)."""
    (df.repartition(buckets, key).sortWithinPartitions(key, *order)
     .write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *order).saveAsTable(table))


def training_rows(spark: SparkSession, tiles_table: str, elements_table: str, key: str = "patch_id") -> DataFrame:
    """Tile rows with the columns of their element (shard, position...), for
    assembly with those as ``keep``: both stores have the same buckets, so
    neither the join nor the assembly exchanges a row. Elements without tiles keep a row."""
    elements = spark.table(elements_table)
    return elements.hint("merge").join(spark.table(tiles_table), key, "left")


def write_shards(samples: DataFrame, path: str, files_per_shard: int = 1, shard_cols: Sequence[str] = ("split", "shard"),
                 pos_col: str = "shard_pos") -> None:
    """One folder per shard with Parquet files whose rows are in order of
    ``pos_col``; file names in order give the shard in order. Rows are dealt by
    range over (shard, position), so a shard of any size is written by several tasks."""
    spark = samples.sparkSession
    keys = [*shard_cols, pos_col]
    n = max(files_per_shard * samples.select(*shard_cols).distinct().count(), 1)
    n = min(n, int(spark.conf.get("spark.sql.shuffle.partitions", "200")) * max(files_per_shard, 1))
    samples.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(*shard_cols).parquet(path)


def read_shard(spark: SparkSession, path: str, pos_col: str = "shard_pos", **shard) -> DataFrame:
    """The rows of one shard (``split="train", shard=2``), in order; other shards' folders are not read."""
    df = spark.read.parquet(path)
    for name, value in shard.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df.orderBy(pos_col)
