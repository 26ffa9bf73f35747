"""Band files as a Spark data source: only the files that a query asks for
are opened, each in its own dtype.

``read_band_files`` is a batch source with columns dir_name, band, path, size, raster,
error. Filters on ``band`` and ``dir_name`` (equality, ``IN``) are pushed into it: they
choose among the listed paths before any partition is made, so files that do
not match are in no partition and never opened. Partitions are packed by size: as
many files, in path order, as fit ``maxPartitionBytes`` at ``openCostBytes`` for
each file's opening.

The listing goes through Arrow's file systems (local, S3, GCS, HDFS by URI),
once, when the query is planned; like Spark's own file sources the planner holds
the paths of the chosen files. For more directories than fit an ``IN`` list
``ingest_rasters`` lists with Spark, joins the wanted directories as tables and
opens the remaining paths inside tasks.

A file that cannot be read or decoded is a row with an ``error`` and a NULL raster.
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from tessera.functions.paths import extract_or_null
from tessera.operators.rasters import ARROW_RASTER, RASTER, as_raster
from tessera.sources.bandfiles import FILE_REGEX, MODEL_BANDS, directory_keys

Decoder = Callable[[bytes, str], np.ndarray]
SOURCE = "tessera_bands"
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
MAX_PARTITION_BYTES = 128 * 1024 * 1024
OPEN_COST_BYTES = 256 * 1024
BATCH_BYTES = 16 * 1024 * 1024
# Directory names that go into one pushed IN list; more are joined as a table.
MAX_PUSHED = 10_000

BAND_FILES = T.StructType([
    T.StructField("dir_name", T.StringType()), T.StructField("band", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("size", T.LongType()), T.StructField("raster", RASTER), T.StructField("error", T.StringType())])


def decode_npy(data: bytes, path: str) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def open_file(path: str) -> bytes:
    """The bytes of a local path or of a URI that Arrow has a file system for."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        store, inner = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if re.match("file:/[^/]", path) else path)
    else:
        store, inner = fs.LocalFileSystem(), path
    with store.open_input_stream(inner) as stream:
        return stream.read()


def raster_batches(files: Iterator[tuple], decoder: Decoder, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Batches of (``names``..., raster, error) for tuples whose field 'path' is opened and decoded."""
    at = list(names).index("path")
    heads: list[tuple] = []
    rasters: list[dict | None] = []
    errors: list[str | None] = []
    held = 0

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64() if n == "size" else pa.string()) for n, c in zip(names, zip(*heads))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(rasters, ARROW_RASTER), pa.array(errors, pa.string())], names=[*names, "raster", "error"])

    for head in files:
        raster, error = None, None
        try:
            raster = as_raster(decoder(open_file(head[at]), head[at]))
            held += len(raster["data"])
        except Exception as e:  # noqa: BLE001 - a bad file is data, not a crash
            error = f"{type(e).__name__}: {e}"
        heads.append(head)
        rasters.append(raster)
        errors.append(error)
        if held >= BATCH_BYTES:
            yield flush()
            heads, rasters, errors, held = [], [], [], 0
    if heads:
        yield flush()


@dataclass
class Files(InputPartition):
    rows: list[tuple]  # (dir_name, band, path, size)


def pack_by_size(rows: list[tuple], most: int, open_cost: int) -> list[Files]:
    """Consecutive rows in partitions of at most ``most`` bytes, opening included (one row at least)."""
    parts, held = [], 0
    for row in rows:
        cost = row[3] + open_cost
        if not parts or held + cost > most:
            parts.append(Files([]))
            held = 0
        parts[-1].rows.append(row)
        held += cost
    return parts


class BandFileReader(DataSourceReader):
    def __init__(self, roots: list[str], decoder: Decoder, most: int, open_cost: int):
        self.roots, self.decoder, self.most, self.open_cost = roots, decoder, most, open_cost
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", (None,))[0]
            if column not in ("band", "dir_name"):
                yield f
            elif isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted[column] & values if column in self.wanted else values
            elif not isinstance(f, IsNotNull):  # neither column is ever NULL
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        rows, name = [], re.compile(FILE_REGEX)
        for root in self.roots:
            store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
            scheme = root.split("://")[0] + "://" if "://" in root else ""
            for info in store.get_file_info(fs.FileSelector(base, recursive=True)):
                found = name.search(info.path) if info.is_file else None
                if found is None:
                    continue
                dir_name, band = found[1], found[2]
                if all(v in self.wanted[c] for c, v in (("dir_name", dir_name), ("band", band)) if c in self.wanted):
                    rows.append((dir_name, band, scheme + info.path, info.size or 0))
        rows.sort(key=lambda r: r[2])
        return pack_by_size(rows, self.most, self.open_cost)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return raster_batches(iter(partition.rows), self.decoder, ("dir_name", "band", "path", "size"))


def band_source(decoder: Decoder) -> type[DataSource]:
    """The data source with a decoder of its own (bytes, path) -> array."""
    class BandFileSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return SOURCE

        def schema(self) -> T.StructType:
            return BAND_FILES

        def reader(self, schema: T.StructType) -> DataSourceReader:
            o = self.options
            return BandFileReader(json.loads(o["roots"]), decoder, int(o.get("maxpartitionbytes", MAX_PARTITION_BYTES)),
                                  int(o.get("opencostbytes", OPEN_COST_BYTES)))

    return BandFileSource


def read_band_files(spark: SparkSession, roots: str | Sequence[str], decoder: Decoder = decode_npy,
                    max_partition_bytes: int = MAX_PARTITION_BYTES, open_cost_bytes: int = OPEN_COST_BYTES) -> DataFrame:
    """Band files below ``roots`` (``<dir>/<dir>_<band>.<ext>``) as a frame of
    BAND_FILES; filter it on ``band`` and ``dir_name`` to choose what is opened."""
    spark.conf.set(PUSHDOWN_CONF, "true")
    spark.dataSource.register(band_source(decoder))
    return (spark.read.format(SOURCE).option("roots", json.dumps([roots] if isinstance(roots, str) else list(roots)))
            .option("maxPartitionBytes", str(max_partition_bytes)).option("openCostBytes", str(open_cost_bytes)).load())


def open_rasters(files: DataFrame, decoder: Decoder = decode_npy, keep: Sequence[str] = ()) -> DataFrame:
    """(path, ``keep``...: strings) -> the same rows with raster and error, opened inside tasks."""
    names = [*keep, "path"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + BAND_FILES.fields[-2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*[b.column(n).to_pylist() for n in names]))
        return raster_batches(rows, decoder, names)

    return files.select(*[F.col(n).cast("string").alias(n) for n in names]).mapInArrow(run, schema)


def ingest_rasters(spark: SparkSession, roots: str | Sequence[str], meta: DataFrame, decoder: Decoder = decode_npy,
                   bands: Sequence[str] = MODEL_BANDS, max_pushed: int = MAX_PUSHED) -> DataFrame:
    """Typed band tiles of the patches in ``meta`` (patch_id, s1_name), and of
    no others: patch_id, band, path, raster, error. Sample ``meta`` first: a
    sample of 1 % opens 1 % of the files.

    Up to ``max_pushed`` directories are pushed into the source; beyond that the
    paths are listed by Spark without their content, joined to the wanted
    directories, spread by hash and opened where they land."""
    keys = directory_keys(meta)
    some = [r["dir_name"] for r in keys.select("dir_name").distinct().limit(max_pushed + 1).collect()]
    if len(some) <= max_pushed:
        files = read_band_files(spark, roots, decoder)
        chosen = files.filter(F.col("band").isin(list(bands)) & F.col("dir_name").isin(some))
        return chosen.join(keys, "dir_name").select("patch_id", "band", "path", "raster", "error")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([roots] if isinstance(roots, str) else list(roots))
    listed = listed.select("path", extract_or_null("path", FILE_REGEX, 1).alias("dir_name"), extract_or_null("path", FILE_REGEX, 2).alias("band"))
    wanted = listed.filter(F.col("band").isin(list(bands))).join(keys, "dir_name")
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return open_rasters(wanted.repartition(n, "path"), decoder, keep=("patch_id", "band")).select("patch_id", "band", "path", "raster", "error")
