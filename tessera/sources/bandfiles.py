"""Band-file ingest: one distributed listing, Arrow-batched decode.

``spark.read.format("binaryFile")`` lists every file under the roots once
(``recursiveFileLookup``) and reads the bytes inside the tasks; a glob on
the file name keeps only the bands the model needs. Decoding is a user
callback (GeoTIFF readers are not bundled); ``.npy`` and raw little-endian
buffers are built in. A file that fails to decode becomes a row with an
``error`` and NULL pixels, never a failed job.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.paths import extract_or_null

Decoder = Callable[[bytes, str], np.ndarray]

DECODED = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("pixels", T.ArrayType(T.DoubleType())),
    T.StructField("error", T.StringType()),
])

# <dir>/<dir>_<band>.<ext>: the directory names the patch (S2, label) or
# the S1 product; the suffix names the band.
MODEL_BANDS = ("VV", "VH", "B02", "B03", "B04", "B08", "reference_map")
FILE_REGEX = r"([^/]+)/\1_([^/]+)\.[A-Za-z0-9]+$"


def decode_npy(data: bytes, path: str) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def raw_decoder(dtype: str, height: int, width: int) -> Decoder:
    def decode(data: bytes, path: str) -> np.ndarray:
        return np.frombuffer(data, dtype=np.dtype(dtype).newbyteorder("<")).reshape(1, height, width)
    return decode


def list_band_files(spark: SparkSession, roots: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, length, content) of every file below ``roots``; one listing
    job, no per-row storage calls."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(roots if isinstance(roots, list) else [roots]).select("path", "length", "content")


def decode_band_files(files: DataFrame, decoder: Decoder = decode_npy) -> DataFrame:
    """(path, content) -> DECODED rows; all samples of all raster bands, band
    after band and row-major, widened to double (bands = size / (h * w))."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = {k: [] for k in DECODED.fieldNames()}
            for path, content in zip(pdf["path"], pdf["content"]):
                out["path"].append(path)
                try:
                    arr = np.asarray(decoder(bytes(content), path))
                    if arr.ndim == 2:
                        arr = arr[None, :, :]
                    if arr.ndim != 3:
                        raise ValueError(f"expected (bands, h, w), got shape {arr.shape}")
                    out["height"].append(int(arr.shape[1]))
                    out["width"].append(int(arr.shape[2]))
                    out["dtype"].append(str(arr.dtype))
                    out["pixels"].append(arr.reshape(-1).astype(np.float64))
                    out["error"].append(None)
                except Exception as e:  # noqa: BLE001 - a bad file is data, not a crash
                    out["height"].append(None)
                    out["width"].append(None)
                    out["dtype"].append(None)
                    out["pixels"].append(None)
                    out["error"].append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame(out)

    return files.select("path", "content").mapInPandas(run, DECODED)


def band_tiles_from_files(decoded: DataFrame) -> DataFrame:
    """Add (dir_name, band) parsed from the path: FX4 rows keyed by the
    directory name (patch id for S2 and label maps, S1 product name for
    S1). Use :func:`attach_patch_ids` to key everything by patch id."""
    return decoded.select(extract_or_null("path", FILE_REGEX, 1).alias("dir_name"),
                          extract_or_null("path", FILE_REGEX, 2).alias("band"),
                          "path", "height", "width", "dtype", "pixels", "error")


def directory_keys(meta: DataFrame) -> DataFrame:
    """(dir_name, patch_id): S2 and label directories are named by the patch
    id, S1 directories by the S1 product name."""
    return (meta.select(F.col("patch_id").alias("dir_name"), "patch_id")
            .unionByName(meta.filter(F.col("s1_name").isNotNull())
                         .select(F.col("s1_name").alias("dir_name"), "patch_id")))


def attach_patch_ids(tiles: DataFrame, meta: DataFrame) -> DataFrame:
    """Map directory names to patch ids with one equi-join against a
    two-column key table built from the metadata."""
    return tiles.join(directory_keys(meta), "dir_name", "inner")


def ingest_band_files(spark: SparkSession, roots: str | list[str], meta: DataFrame,
                      decoder: Decoder = decode_npy, glob: str | None = None,
                      bands: Sequence[str] | None = MODEL_BANDS) -> DataFrame:
    """List, decode and key band files: FX4 rows plus ``error``. Files of
    other bands (``bands=None``: of none) and of patches that ``meta`` does
    not hold are left out by their path, before anything is decoded."""
    files = list_band_files(spark, roots, glob).withColumn("dir_name", extract_or_null("path", FILE_REGEX, 1))
    if bands is not None:
        files = files.filter(extract_or_null("path", FILE_REGEX, 2).isin(list(bands)))
    files = files.join(directory_keys(meta).select("dir_name"), "dir_name", "left_semi")
    return attach_patch_ids(band_tiles_from_files(decode_band_files(files, decoder)), meta)
