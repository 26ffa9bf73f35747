"""Metadata scans with pruning read schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.paths import paths_array, strip_scheme
from tessera.schemas import METADATA, METADATA_M1, METADATA_M2


def read_metadata(spark: SparkSession, path: str, schema: T.StructType = METADATA_M1,
                  splits: Sequence[str] | None = ("train", "test"), split_col: str = "split") -> DataFrame:
    """Parquet scan that reads only the columns of ``schema`` (ReadSchema)
    and, when ``splits`` is given, keeps those splits; the ``In`` filter is
    pushed into the Parquet reader (row-group skipping, and partition
    pruning when the table is partitioned by ``split``)."""
    df = spark.read.schema(schema).parquet(path)
    if splits is not None:
        df = df.filter(F.col(split_col).isin(list(splits)))
    return df


def read_full_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA).parquet(path)


def read_m2_metadata(spark: SparkSession, path: str,
                     splits: Sequence[str] | None = ("train", "test")) -> DataFrame:
    """The six M2 columns. File sources read every field as nullable, so
    the declared non-null contract is asserted by :func:`assert_not_null`."""
    return read_metadata(spark, path, METADATA_M2, splits)


def assert_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fails the job on the first NULL in ``cols`` (ANSI ``assert_true``)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(F.assert_true(cond, F.lit(f"NULL in one of {list(cols)}")).isNull())


def prepare_paths(meta: DataFrame, with_patch_id: bool = False) -> DataFrame:
    """Strip the scheme of the three directory paths and add ``paths_array``
    = [s1, s2, label] (+ patch_id as 4th element when asked)."""
    out = meta
    for c in ("s1_path", "s2_path", "label_path"):
        out = out.withColumn(c, strip_scheme(c))
    cols = ["s1_path", "s2_path", "label_path"] + (["patch_id"] if with_patch_id else [])
    name = "patch_path_array" if with_patch_id else "paths_array"
    return out.withColumn(name, paths_array(*cols))
