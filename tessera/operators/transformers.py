"""The pixel-classification stages as persistable ``pyspark.ml`` Transformers.

State lives in Params only (paths, names, variants), so every stage saves
and loads with ``DefaultParamsWritable`` / ``DefaultParamsReadable``. Each
``_transform`` is a thin wrapper over the DataFrame operators.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import indices as I
from tessera.operators import labels as L
from tessera.operators import rasters as RA
from tessera.operators import tiles as TL
from tessera.schemas import FEATURE_COLUMNS


class _Base(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def _set_params(self, **kwargs):
        return self._set(**{k: v for k, v in kwargs.items() if v is not None})


class PixelExtractor(_Base):
    """Patch rows (with ``keyCol``) -> patch rows + FX5 pixel arrays.

    The band tiles (FX4 long form) are a table at ``tilesPath`` (Parquet,
    e.g. written by :func:`tessera.sources.bandfiles.ingest_band_files`), or
    an in-memory frame given with :meth:`with_tiles` (not persisted). The
    join on the patch key and the per-patch pivot share one shuffle.
    """

    keyCol = Param(Params._dummy(), "keyCol", "patch key column", TypeConverters.toString)
    tilesPath = Param(Params._dummy(), "tilesPath", "Parquet path of band tiles", TypeConverters.toString)
    keepCols = Param(Params._dummy(), "keepCols", "input columns to keep", TypeConverters.toListString)

    def __init__(self, keyCol: str = "patch_id", tilesPath: str | None = None,
                 keepCols: list[str] | None = None):
        super().__init__()
        self._setDefault(keyCol="patch_id", keepCols=[])
        self._set_params(keyCol=keyCol, tilesPath=tilesPath, keepCols=keepCols)
        self._tiles: DataFrame | None = None

    def with_tiles(self, tiles: DataFrame) -> "PixelExtractor":
        self._tiles = tiles
        return self

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key = self.getOrDefault("keyCol")
        keep = [c for c in self.getOrDefault("keepCols") if c != key]
        tiles = self._tiles
        if tiles is None:
            tiles = dataset.sparkSession.read.parquet(self.getOrDefault("tilesPath"))
        wanted = tiles.join(dataset.select(key, *keep), key, "left_semi") if not keep else \
            tiles.join(dataset.select(key, *keep), key, "inner")
        if "raster" in tiles.columns:  # typed tiles stay typed
            return RA.assemble_rasters(wanted, key=key, keep=keep, partitions=TL.patch_partitions(tiles))
        return TL.pivot_bands(wanted, key=key, keep=keep, partitions=TL.patch_partitions(tiles))

    def write(self):
        if self._tiles is not None and not self.isDefined("tilesPath"):
            raise ValueError("tiles given by with_tiles are not saved: write them as a table and set tilesPath")
        return super().write()


class PixelExploder(_Base):
    """Patch pixel arrays -> one row per pixel (key, pos, bands, label)."""

    keyCol = Param(Params._dummy(), "keyCol", "patch key column", TypeConverters.toString)
    keepCols = Param(Params._dummy(), "keepCols", "columns to carry per pixel", TypeConverters.toListString)

    def __init__(self, keyCol: str = "patch_id", keepCols: list[str] | None = None):
        super().__init__()
        self._setDefault(keyCol="patch_id", keepCols=[])
        self._set_params(keyCol=keyCol, keepCols=keepCols)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, keep = self.getOrDefault("keyCol"), self.getOrDefault("keepCols")
        if isinstance(dataset.schema["VV"].dataType, T.StructType):
            return RA.raster_pixels(dataset, key=key, keep=keep)
        return TL.explode_pixels(dataset, key=key, keep=keep)


class IndexCalculator(_Base):
    """Adds NDVI, EVI, NDWI, BVI, RRadio, RDiff, RSum, RVI."""

    ndwiVariant = Param(Params._dummy(), "ndwiVariant", "as_written | normalized", TypeConverters.toString)

    def __init__(self, ndwiVariant: str = I.NDWI_AS_WRITTEN):
        super().__init__()
        self._setDefault(ndwiVariant=I.NDWI_AS_WRITTEN)
        self._set_params(ndwiVariant=ndwiVariant)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return I.with_indices(dataset, self.getOrDefault("ndwiVariant"))


class LabelRecoder(_Base):
    """Inner join with the label dictionary (broadcast); ``target`` selects
    sparse ids (``ID_NEW``: 1..44, 99) or dense ids (``CLASS``: 0..44)."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "ID_NEW | CLASS", TypeConverters.toString)
    dictionaryPath = Param(Params._dummy(), "dictionaryPath", "optional CSV dictionary",
                           TypeConverters.toString)

    def __init__(self, labelCol: str = "label", target: str = "CLASS",
                 dictionaryPath: str | None = None):
        super().__init__()
        self._setDefault(labelCol="label", target="CLASS")
        self._set_params(labelCol=labelCol, target=target, dictionaryPath=dictionaryPath)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        d = L.read_label_dictionary(spark, self.getOrDefault("dictionaryPath")) if self.isDefined("dictionaryPath") else L.label_dictionary(spark)
        return L.recode_labels(dataset, d, self.getOrDefault("labelCol"), self.getOrDefault("target"))


class FeatureAssembler(_Base):
    """VectorAssembler over the 14 band + index columns with
    ``handleInvalid='skip'`` (drops pixels with NULL or NaN features, keeps
    +-inf). Output: features, label, plus ``keepCols``."""

    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    keepCols = Param(Params._dummy(), "keepCols", "columns to carry", TypeConverters.toListString)

    def __init__(self, inputCols: list[str] | None = None, labelCol: str = "label",
                 keepCols: list[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=list(FEATURE_COLUMNS), labelCol="label", keepCols=[])
        self._set_params(inputCols=inputCols, labelCol=labelCol, keepCols=keepCols)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        va = VectorAssembler(inputCols=self.getOrDefault("inputCols"), outputCol="features",
                             handleInvalid="skip")
        label = self.getOrDefault("labelCol")
        return va.transform(dataset).select(*self.getOrDefault("keepCols"), "features",
                                            F.col(label).alias("label"))


class Persist(_Base):
    """Pipeline stage that keeps its input for the multiple passes the next
    estimator makes (MEMORY_AND_DISK; recomputed from lineage on loss)."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.persist(StorageLevel.MEMORY_AND_DISK)
