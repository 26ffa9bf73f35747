"""Rasters in their own dtype: bytes, dtype and shape travel together from the
decoder to the stack.

A raster is a struct (data, dtype, planes, height, width): little-endian
samples, plane after plane and row-major, as the file held them. Nothing is
widened on the way; where rasters of several dtypes meet in one stack, numpy's
promotion decides (float32 with uint16 gives float32).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.assembly import assemble
from tessera.operators.tiles import DEFAULT_BANDS, PIXEL_FIELD
from tessera.schemas import IMAGE_CHANNELS, LABEL_BAND

RASTER = T.StructType([
    T.StructField("data", T.BinaryType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("planes", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
])
ARROW_RASTER = pa.struct([("data", pa.binary()), ("dtype", pa.string()), ("planes", pa.int32()), ("height", pa.int32()), ("width", pa.int32())])
#: Rows of exploded pixels or values that one Arrow batch may hold.
ROWS_AT_ONCE = 500_000


def as_raster(arr: np.ndarray) -> dict:
    """An array (h, w) or (planes, h, w) as a raster."""
    arr = np.asarray(arr)
    if arr.ndim == 2:
        arr = arr[None, :, :]
    if arr.ndim != 3:
        raise ValueError(f"expected (planes, h, w), got shape {arr.shape}")
    little = arr.astype(arr.dtype.newbyteorder("<"), copy=False)
    return {"data": little.tobytes(), "dtype": arr.dtype.name, "planes": arr.shape[0], "height": arr.shape[1], "width": arr.shape[2]}


def values_of(raster: dict) -> np.ndarray:
    """All samples of a raster, flat, in its dtype."""
    return np.frombuffer(raster["data"], np.dtype(raster["dtype"]).newbyteorder("<")).astype(raster["dtype"], copy=False)


def pack(tiles: DataFrame, pixels_col: str = "pixels", dtype_col: str = "dtype", out: str = "raster") -> DataFrame:
    """Tiles with ``pixels`` (array), ``dtype``, ``height`` and ``width`` ->
    the same rows with a raster instead of the array. NULL where a pixel is
    missing, the count is not height x width, or a value does not fit the dtype."""
    schema = T.StructType([f for f in tiles.schema.fields if f.name != pixels_col] + [T.StructField(out, RASTER)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pixels, dtypes = batch.column(pixels_col), batch.column(dtype_col).to_pylist()
            hs, ws = batch.column("height").to_pylist(), batch.column("width").to_pylist()
            made = []
            for i in range(batch.num_rows):
                row = pixels[i].values
                ok = row is not None and dtypes[i] and row.null_count == 0 and hs[i] is not None and ws[i] is not None and len(row) == hs[i] * ws[i]
                if ok:
                    wide = row.to_numpy(zero_copy_only=False)
                    with np.errstate(invalid="ignore", over="ignore"):
                        arr = wide.astype(dtypes[i])
                    ok = np.issubdtype(arr.dtype, np.floating) or bool((arr == wide).all())
                made.append(as_raster(arr.reshape(hs[i], ws[i])) if ok else None)
            kept = [batch.column(f.name) for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made, ARROW_RASTER)], names=schema.fieldNames())

    return tiles.mapInArrow(run, schema)


def assemble_rasters(tiles: DataFrame, bands: Sequence[str] = DEFAULT_BANDS, raster_col: str = "raster", **kw) -> DataFrame:
    """One row per patch: a raster per band (named as in the pixel struct) and ``n_copies``."""
    return assemble(tiles, raster_col, bands, [PIXEL_FIELD.get(b, b) for b in bands], **kw)


def reject_reason(patches: DataFrame, fields: Sequence[str], height: int | None = None, width: int | None = None) -> Column:
    """Why the rasters of a patch cannot be laid over each other, else NULL:
    ``missing:<fields>``, ``planes:<fields>`` (a file of several raster bands),
    ``size:<fields>`` (another size than asked for or than the first field's)."""
    def listed(word: str, bad) -> Column:
        names = F.array_compact(F.array(*[F.when(bad(F.col(f)), F.lit(f)) for f in fields]))
        return F.when(F.size(names) > 0, F.concat(F.lit(word + ":"), F.array_join(names, ",")))

    first = F.col(fields[0])
    h = F.lit(height) if height is not None else first["height"]
    w = F.lit(width) if width is not None else first["width"]
    return F.coalesce(listed("missing", lambda c: c.isNull()), listed("planes", lambda c: c["planes"] != 1),
                      listed("size", lambda c: (c["height"] != h) | (c["width"] != w)))


def split_rejects(patches: DataFrame, fields: Sequence[str], height: int | None = None, width: int | None = None,
                  reason_col: str = "reject_reason") -> DataFrame:
    """The patches with ``reject_reason``: NULL for good ones. One pass; filter
    it, or write it partitioned by whether the reason is NULL, to have both."""
    return patches.withColumn(reason_col, reject_reason(patches, fields, height, width))


def stack(patches: DataFrame, fields: Sequence[str] = tuple(PIXEL_FIELD[b] for b in IMAGE_CHANNELS), height: int | None = None,
          width: int | None = None, key: str = "patch_id", keep: Sequence[str] = (), out: str = "bands",
          also: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Per patch the (C, 1, H, W) stack of the rasters in ``fields``, as
    little-endian bytes of the promoted dtype, with dtype, channels, height,
    width and reject_reason. All or nothing: NULL bytes where a raster is
    missing, has several planes or another size. ``also`` names further byte
    columns stacked in the same pass (their dtypes: ``<name>_dtype``)."""
    groups = {out: list(fields), **{k: list(v) for k, v in (also or {}).items()}}
    src = split_rejects(patches, fields, height, width)
    src = src.withColumns({f"{g}__bad": reject_reason(patches, f, height, width).isNotNull() for g, f in groups.items()})
    cols = list(dict.fromkeys([key, *keep, "reject_reason", *[f"{g}__bad" for g in groups], *[f for fs in groups.values() for f in fs]]))
    head = ["dtype", "channels", "height", "width"]
    schema = T.StructType([src.schema[c] for c in (key, *keep)] + [T.StructField(out, T.BinaryType()), T.StructField("dtype", T.StringType())]
                          + [T.StructField(c, T.IntegerType()) for c in head[1:]] + [T.StructField("reject_reason", T.StringType())]
                          + [f for g in list(groups)[1:] for f in (T.StructField(g, T.BinaryType()), T.StructField(f"{g}_dtype", T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list] = {f.name: [] for f in schema.fields[1 + len(keep):]}
            made["reject_reason"] = batch.column("reject_reason").to_pylist()
            for i in range(batch.num_rows):
                for g, names in groups.items():
                    if batch.column(f"{g}__bad")[i].as_py():
                        data, dtype, shape = None, None, (None, None, None)
                    else:
                        rasters = [batch.column(f)[i].as_py() for f in names]
                        kind = np.result_type(*[np.dtype(r["dtype"]) for r in rasters])
                        data = b"".join(values_of(r).astype(kind.newbyteorder("<"), copy=False).tobytes() for r in rasters)
                        dtype, shape = kind.name, (len(rasters), rasters[0]["height"], rasters[0]["width"])
                    made[g].append(data)
                    made["dtype" if g == out else f"{g}_dtype"].append(dtype)
                    if g == out:
                        for c, v in zip(head[1:], shape):
                            made[c].append(v)
            kept = [batch.column(c) for c in (key, *keep)]
            yield pa.RecordBatch.from_arrays(
                [*kept, *[pa.array(made[f.name], _ARROW[type(f.dataType)]) for f in schema.fields[1 + len(keep):]]], names=schema.fieldNames())

    return src.select(*cols).mapInArrow(run, schema)


_ARROW = {T.BinaryType: pa.binary(), T.StringType: pa.string(), T.IntegerType: pa.int32()}


def unstack(stacked: DataFrame, key: str = "patch_id", data_col: str = "bands", dtype_col: str = "dtype", keep: Sequence[str] = ()) -> DataFrame:
    """Stacked bytes -> one row per sample: key, ``keep``, channel, pos (row-major), value."""
    schema = T.StructType([stacked.schema[c] for c in (key, *keep)] + [
        T.StructField("channel", T.IntegerType()), T.StructField("pos", T.IntegerType()), T.StructField("value", T.DoubleType())])
    src = stacked.select(key, *keep, F.col(data_col).alias("__data"), F.col(dtype_col).alias("__dtype"),
                         *[F.col(c).alias(f"__{c}") for c in ("channels", "height", "width")]).filter("__data IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                kind = np.dtype(batch.column("__dtype")[i].as_py()).newbyteorder("<")
                c = batch.column("__channels")[i].as_py()
                flat = np.frombuffer(batch.column("__data")[i].as_py(), kind).reshape(c, -1)
                n = flat.shape[1]
                for at in range(0, flat.size, ROWS_AT_ONCE):
                    part = np.arange(at, min(at + ROWS_AT_ONCE, flat.size))
                    heads = [batch.column(x).take(pa.array(np.full(len(part), i))) for x in (key, *keep)]
                    yield pa.RecordBatch.from_arrays(
                        [*heads, pa.array((part // n).astype(np.int32)), pa.array((part % n).astype(np.int32)),
                         pa.array(flat.reshape(-1)[part].astype(np.float64))], names=schema.fieldNames())

    return src.mapInArrow(run, schema)


def raster_pixels(patches: DataFrame, fields: Sequence[str] = tuple(PIXEL_FIELD[b] for b in DEFAULT_BANDS), key: str = "patch_id",
                  keep: Sequence[str] = ()) -> DataFrame:
    """One row per pixel of the patches whose rasters are all there and of one
    size: key, ``keep``, pos and a column per field (radar bands double, others
    bigint). Other patches give no pixels; :func:`split_rejects` names them."""
    floating = {"VV", "VH"}
    schema = T.StructType([patches.schema[c] for c in (key, *keep)] + [T.StructField("pos", T.IntegerType())]
                          + [T.StructField(f, T.DoubleType() if f in floating else T.LongType()) for f in fields])
    good = split_rejects(patches, fields).filter("reject_reason IS NULL").select(key, *keep, *fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cols = [values_of(batch.column(f)[i].as_py()).astype(np.float64 if f in floating else np.int64) for f in fields]
                n = len(cols[0])
                for at in range(0, n, ROWS_AT_ONCE):
                    m = min(ROWS_AT_ONCE, n - at)
                    heads = [batch.column(x).take(pa.array(np.full(m, i))) for x in (key, *keep)]
                    yield pa.RecordBatch.from_arrays([*heads, pa.array(np.arange(at, at + m, dtype=np.int32)), *[pa.array(c[at : at + m]) for c in cols]],
                                                     names=schema.fieldNames())

    return good.mapInArrow(run, schema)


def label_raster(patches: DataFrame, key: str = "patch_id") -> DataFrame:
    """Per patch the label raster's bytes and header, alone."""
    return stack(patches, (PIXEL_FIELD[LABEL_BAND],), key=key, out="label_map")
