"""Sinks: Parquet tables for patches, metadata and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_patches(df: DataFrame, path: str, partition_by_split: bool = True) -> None:
    """Materialised patches, overwrite; partitioned by ``split`` so readers
    of one split prune the others at the directory level."""
    w = df.write.mode("overwrite")
    if partition_by_split and "split" in df.columns:
        w = w.partitionBy("split")
    w.parquet(path)


def write_metadata(df: DataFrame, path: str) -> None:
    """Enriched or processed metadata, overwrite (a distributed write, no
    driver round trip)."""
    df.write.mode("overwrite").parquet(path)


def write_runs(df: DataFrame, path: str, schema: T.StructType, run_col: str = "run") -> None:
    """Rows of whole runs into a table of one ``schema`` (STAGE_TIMING or
    EPOCH_HISTORY; each has a table of its own), one folder per run. The runs in ``df`` replace what the
    table holds of them, and no other: a retry, or a second write, leaves the same rows."""
    if {(f.name, f.dataType) for f in df.schema.fields} != {(f.name, f.dataType) for f in schema.fields}:
        raise ValueError(f"expected {schema.simpleString()}, got {df.schema.simpleString()}")
    df.select(*schema.fieldNames()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_col).parquet(path)


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def append_run_metrics(df: DataFrame, path: str) -> None:
    """Append rows to a metrics table. A retry appends them again: use
    :func:`write_runs` for stage timings and epoch histories."""
    df.write.mode("append").parquet(path)
