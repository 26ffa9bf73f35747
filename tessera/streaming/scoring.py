"""Incremental scoring of arriving band tiles (Structured Streaming).

Band files of one patch can land in different micro-batches, so patches are
assembled by a keyed stateful operator: per patch the state holds at most
one array per expected band (bounded, never grows with the stream). A patch
is emitted once all bands are present. Event time is the arrival time of
each band file (its modification time, so replays see the same value); a
watermark trails the newest arrival by the allowed lateness, and a patch
whose last band arrived before the watermark is emitted incomplete, with
its ``missing_bands``, so it can be quarantined and its state dropped.
Each micro-batch of complete patches is then scored with a fitted pipeline
model through ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.operators.tiles import DEFAULT_BANDS, PIXEL_FIELD
from tessera.schemas import BAND_TILE, S1_BANDS

STATE_SCHEMA = T.StructType([
    T.StructField("bands", T.ArrayType(T.StringType())),
    T.StructField("pixels", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("last_arrival_ms", T.LongType()),
])


def assembled_schema(bands: Sequence[str] = DEFAULT_BANDS) -> T.StructType:
    fields = [T.StructField("patch_id", T.StringType())]
    for b in bands:
        el = T.DoubleType() if b in S1_BANDS else T.LongType()
        fields.append(T.StructField(PIXEL_FIELD.get(b, b), T.ArrayType(el)))
    fields.append(T.StructField("missing_bands", T.ArrayType(T.StringType())))
    return T.StructType(fields)


def assemble_patches(tiles: DataFrame, lateness_ms: int = 600_000,
                     bands: Sequence[str] = DEFAULT_BANDS, arrival_col: str = "arrived") -> DataFrame:
    """Streaming FX4 band tiles with an arrival timestamp -> one row per
    patch (FX5 arrays plus ``missing_bands``), emitted when complete or when
    the watermark passes the patch's last arrival."""
    bands = list(bands)
    schema = assembled_schema(bands)

    def emit(key: str, have: dict[str, list]) -> pd.DataFrame:
        row = {"patch_id": [key]}
        for b in bands:
            v = have.get(b)
            if v is not None and b not in S1_BANDS:
                v = [int(x) for x in v]
            row[PIXEL_FIELD.get(b, b)] = [v]
        row["missing_bands"] = [[b for b in bands if b not in have]]
        return pd.DataFrame(row)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        patch_id = key[0]
        if state.hasTimedOut:
            stored = state.get
            have = dict(zip(stored[0], stored[1]))
            state.remove()
            yield emit(patch_id, have)
            return
        have: dict[str, list] = {}
        last = 0
        if state.exists:
            stored = state.get
            have = dict(zip(stored[0], stored[1]))
            last = int(stored[2])
        for pdf in batches:
            for band, px, t in zip(pdf["band"], pdf["pixels"], pdf[arrival_col]):
                last = max(last, int(pd.Timestamp(t).value // 1_000_000))
                if band in bands and band not in have:
                    have[band] = [float(x) for x in px] if px is not None else None
        if all(b in have for b in bands):
            state.remove()
            yield emit(patch_id, have)
        else:
            names = sorted(have)
            state.update((names, [have[n] for n in names], last))
            state.setTimeoutTimestamp(last + 1)

    return (tiles.select("patch_id", "band", "pixels", arrival_col)
            .withWatermark(arrival_col, f"{int(lateness_ms)} milliseconds")
            .groupBy("patch_id")
            .applyInPandasWithState(step, schema, STATE_SCHEMA, "append",
                                    GroupStateTimeout.EventTimeTimeout))


def read_tile_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of FX4 band-tile Parquet files plus ``arrived``: the file's
    modification time (event time of the band)."""
    reader = spark.readStream.schema(BAND_TILE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).withColumn("arrived", F.col("_metadata.file_modification_time"))


def score_stream(spark: SparkSession, tiles_dir: str, model: PipelineModel, meta: DataFrame,
                 output_dir: str, checkpoint_dir: str, quarantine_dir: str | None = None,
                 available_now: bool = True, lateness_ms: int = 600_000) -> StreamingQuery:
    """Score complete patches as their band files arrive; append
    (patch_id, pos, label, prediction) to ``output_dir``. The model's first
    stage must read pixel arrays from its input (see :func:`scoring_model`).
    Incomplete, timed-out patches go to ``quarantine_dir``."""
    patches = assemble_patches(read_tile_stream(spark, tiles_dir), lateness_ms)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        complete = batch.filter(F.size("missing_bands") == 0).drop("missing_bands")
        scored = model.transform(complete.join(meta.select("patch_id"), "patch_id", "left_semi"))
        scored.select("patch_id", "pos", F.col("label").cast("bigint").alias("label"), "prediction") \
            .write.mode("append").parquet(output_dir)
        if quarantine_dir:
            batch.filter(F.size("missing_bands") > 0).select("patch_id", "missing_bands") \
                .write.mode("append").parquet(quarantine_dir)

    w = patches.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def scoring_model(fitted: PipelineModel) -> PipelineModel:
    """The fitted pipeline without its extraction stage: streaming input
    already carries the pixel arrays."""
    return PipelineModel(stages=list(fitted.stages[1:]))
