"""Band rows -> one row per patch, without comparing arrays.

One exchange and one sort on the patch key (none, if the rows come from a
table bucketed by it), then an iterator over each patch's rows in Arrow
batches. A patch holds one value per band at a time, however many copies of a
band file there are; copies are counted. Before the exchange each Arrow batch
drops the copies it holds itself, so a patch id with a large share of all rows
sends a few rows per batch, not all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of helper columns; inputs may not use them.
TIE, COPIES = "__tie", "__copies"


def order_of(value) -> tuple:
    """A total order of ties and values: NULL first, NaN last, element by element."""
    if value is None:
        return (0,)
    if isinstance(value, dict):
        return (1, *[order_of(x) for x in value.values()])
    if isinstance(value, list):
        return (1, *[order_of(x) for x in value])
    return (2,) if value != value else (1, value)


def _first_copies(key: str, band_col: str, value_col: str):
    """Rows of each batch without later copies of the same (patch, band)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict = {}
            seen: dict = {}
            values, ties = batch.column(value_col), batch.column(TIE if TIE in batch.schema.names else value_col)
            rows = zip(batch.column(key).to_pylist(), batch.column(band_col).to_pylist(), values.is_null().to_pylist())
            for i, (k, band, missing) in enumerate(rows):
                held = best.get((k, band))
                if held is None or (not missing and (values[held].as_py() is None or order_of(ties[i].as_py()) < order_of(ties[held].as_py()))):
                    best[k, band] = i
                if not missing:
                    seen[k, band] = seen.get((k, band), 0) + 1
            if len(best) == batch.num_rows:
                yield batch
                continue
            keep = sorted((i, seen.get(kb, 0)) for kb, i in best.items())
            out = batch.take(pa.array([i for i, _ in keep]))
            at = out.schema.get_field_index(COPIES)
            yield out.set_column(at, out.schema.field(at), pa.array([n for _, n in keep], pa.int64()))

    return run


def _one_row(key: str, band_col: str, value_col: str, bands: Sequence[str], keep: Sequence[str], names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        copies, head, value_type = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if head is None:
                head = batch.select([key, *keep]).slice(0, 1)
                value_type = batch.schema.field(value_col).type
            values, ties = batch.column(value_col), batch.column(TIE if TIE in batch.schema.names else value_col)
            rows = zip(batch.column(band_col).to_pylist(), values.is_null().to_pylist(), batch.column(COPIES).to_pylist())
            for i, (band, missing, n) in enumerate(rows):
                if missing or band not in bands:
                    continue
                copies += n - (band not in best)
                one = pa.array([i])
                if band not in best:  # taken out, so that the batch can go
                    best[band] = (values.take(one), ties.take(one))
                elif order_of(ties[i].as_py()) < order_of(best[band][1][0].as_py()):
                    best[band] = (values.take(one), ties.take(one))
        if head is not None:
            cells = [best[b][0] if b in best else pa.nulls(1, value_type) for b in bands]
            yield pa.RecordBatch.from_arrays([*head.columns, *cells, pa.array([copies], pa.int64())], names=[key, *keep, *names, "n_copies"])

    return run


def assemble(tiles: DataFrame, value_col: str, bands: Sequence[str], names: Sequence[str] | None = None,
             key: str = "patch_id", band_col: str = "band", tie: str | Column | None = None,
             keep: Sequence[str] = (), reduce_copies: bool = True, partitions: int | None = None) -> DataFrame:
    """One row per patch: key, ``keep`` (one value a patch), a column per band
    (``names``) with that band's value or NULL, and ``n_copies``: rows with a
    value beyond the first of their band. Of copies the one with the smallest
    ``tie`` stays (default: the smallest value), whatever the order of rows.
    A patch whose rows have no value keeps its row. ``reduce_copies=False``
    leaves out the pass before the exchange, for tables known to have few copies.
    ``partitions`` fixes the width of the exchange: small bands that become many
    pixels are then not coalesced into few tasks by their bytes."""
    names = list(names or bands)
    value = F.when(F.col(band_col).isin(list(bands)), F.col(value_col))
    order = [] if tie is None else [(F.col(tie) if isinstance(tie, str) else tie).alias(TIE)]
    rows = tiles.select(key, *keep, band_col, value.alias(value_col), *order, F.lit(1).cast("long").alias(COPIES))
    if reduce_copies:
        rows = rows.mapInArrow(_first_copies(key, band_col, value_col), rows.schema)
    if partitions:
        rows = rows.repartition(partitions, key)
    field = rows.schema[value_col].dataType
    schema = T.StructType([rows.schema[c] for c in (key, *keep)] + [T.StructField(n, field) for n in names] + [T.StructField("n_copies", T.LongType())])
    return rows.groupBy(key).applyInArrow(_one_row(key, band_col, value_col, list(bands), list(keep), names), schema)
