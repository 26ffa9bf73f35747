"""Run metrics: stage timing, run-log parsing, run-history summaries.

Timing is driver-side bookkeeping (a context manager) that appends rows to
a ``run_metrics`` table; the analysis of logs and histories is Spark.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.common import epoch_micros, idiv, wall_clock
from tessera.schemas import ACCURACY_LINE, COUNT_LINE, EPOCH_HISTORY, RUNTIME_LINE, STAGE_TIMING


def hms(seconds: float) -> str:
    """HH:MM:SS with truncated seconds (hours may exceed 24)."""
    s = int(seconds)
    return f"{s // 3600:02d}:{(s % 3600) // 60:02d}:{s % 60:02d}"


@dataclass
class StageTimer:
    """Records (run, task, started, finished, seconds) per timed stage."""

    run: str
    rows: list[tuple[str, str, str, str, int]] = field(default_factory=list)
    exact: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def stage(self, task: str) -> Iterator[None]:
        t0 = time.time()
        try:
            yield
        finally:
            t1 = time.time()
            self.exact[task] = t1 - t0
            self.rows.append((self.run, task, time.strftime("%H:%M:%S", time.localtime(t0)),
                              time.strftime("%H:%M:%S", time.localtime(t1)), int(t1 - t0)))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, STAGE_TIMING)



@dataclass
class EpochLog:
    """Records an epoch's metrics and duration, as rows of EPOCH_HISTORY."""

    run: str
    rows: list[tuple] = field(default_factory=list)

    @contextmanager
    def epoch(self, **start: float) -> Iterator[dict[str, float]]:
        """Fill the yielded dict with loss, iou_score, val_loss, val_iou_score."""
        found, t0 = dict(start), time.time()
        yield found  # an epoch that fails leaves no row
        self.rows.append((self.run, len(self.rows) + 1, *[found.get(c) for c in EPOCH_HISTORY.fieldNames()[2:-1]], time.time() - t0))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, EPOCH_HISTORY)


def parse_run_log(lines: DataFrame, run_col: str = "run", value_col: str = "value") -> DataFrame:
    """Log lines (run, value) -> one row per run: seconds of each timed task
    (``fit``, ``evaluation``, ``main``), train/test counts and accuracy.
    Lines of other shapes are ignored."""
    v = F.trim(F.col(value_col))
    secs = (F.regexp_extract(v, RUNTIME_LINE, 2).cast("bigint") * 3600
            + F.regexp_extract(v, RUNTIME_LINE, 3).cast("bigint") * 60
            + F.regexp_extract(v, RUNTIME_LINE, 4).cast("bigint"))
    task = F.lower(F.regexp_extract(v, RUNTIME_LINE, 1))
    is_rt = v.rlike(RUNTIME_LINE)
    is_cnt = v.rlike(COUNT_LINE)
    is_acc = v.rlike(ACCURACY_LINE)

    def task_secs(name: str):
        return F.max(F.when(is_rt & task.startswith(name), secs))

    return lines.groupBy(run_col).agg(
        F.max(F.when(is_cnt & (F.regexp_extract(v, COUNT_LINE, 1) == "train"),
                     F.regexp_extract(v, COUNT_LINE, 2).cast("bigint"))).alias("train_rows"),
        F.max(F.when(is_cnt & (F.regexp_extract(v, COUNT_LINE, 1) == "test"),
                     F.regexp_extract(v, COUNT_LINE, 2).cast("bigint"))).alias("test_rows"),
        task_secs("fit").alias("fit_seconds"),
        task_secs("evaluation").alias("evaluation_seconds"),
        task_secs("main").alias("main_seconds"),
        F.max(F.when(is_acc, F.regexp_extract(v, ACCURACY_LINE, 1).cast("double"))).alias("accuracy"),
    )


def read_run_logs(spark: SparkSession, path: str) -> DataFrame:
    """Text logs (one file per run) -> (run, value); run = file name stem."""
    df = spark.read.text(path).withColumn("_file", F.col("_metadata.file_path"))
    return df.select(F.regexp_extract("_file", r"([^/]+?)(\.[^./]*)?$", 1).alias("run"), "value")


def hms_col(seconds) -> F.Column:
    """Column form of :func:`hms` for bigint seconds."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.concat_ws(":", F.lpad(idiv(s, 3600).cast("string"), 2, "0"),
                       F.lpad(idiv(F.pmod(s, F.lit(3600)), 60).cast("string"), 2, "0"),
                       F.lpad(F.pmod(s, F.lit(60)).cast("string"), 2, "0"))


def run_summary(history: DataFrame, run_col: str = "run", started_col: str = "started",
                loss_col: str = "loss") -> DataFrame:
    """Per run: epochs, first/last start (HH:MM:SS), truncated seconds
    between them and their HH:MM:SS form, mean and minimum loss. One
    aggregation, partial + final."""
    h = history
    if isinstance(h.schema[started_col].dataType, T.StringType):
        h = h.withColumn(started_col, F.col(started_col).cast("timestamp_ntz"))
    us = epoch_micros(h, started_col)
    t = F.col(started_col)
    agg = h.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("n_epochs"), F.min(t).alias("_t0"), F.max(t).alias("_t1"),
        F.min(us).alias("_u0"), F.max(us).alias("_u1"),
        F.avg(loss_col).alias("mean_loss"), F.min(loss_col).alias("min_loss"))
    secs = idiv(F.col("_u1") - F.col("_u0"), 1_000_000)
    return agg.select(run_col, "n_epochs", wall_clock("_t0").alias("started"),
                      wall_clock("_t1").alias("finished"),
                      secs.alias("seconds"), hms_col(secs).alias("runtime"),
                      "mean_loss", "min_loss")


def speed_ups(summary: DataFrame, baseline: str, run_col: str = "run") -> DataFrame:
    """``summary`` with ``speed_up``: the seconds of the run ``baseline`` to
    those of each run; NULL without that run or with no seconds."""
    base = summary.filter(F.col(run_col) == F.lit(baseline)).agg(F.max("seconds").alias("_base"))
    ratio = F.when(F.col("seconds") > 0, F.col("_base") / F.col("seconds"))
    return summary.crossJoin(F.broadcast(base)).withColumn("speed_up", ratio).drop("_base")


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per physical partition (one small aggregation; the partition
    count is ``df.rdd.getNumPartitions()``)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
