"""Adapters from the driver's tables to the raster data model.

The imagery dataset is not available here, so the driver's tables stand in:

* ``embeddings`` -> band tiles. Each 64-float vector is one 8x8 band of one
  patch: patch number ``vec_id div 6``, band ``vec_id mod 6`` in the order
  VV, VH, B02, B03, B04, B08. S1 values are the floats widened to double; S2
  values become digital numbers ``trunc(v * 1000 + 2000)``. A patch that has
  its last band (B08) also gets a reference map whose code at pixel p is
  ``CODE_RULE[pmod(k * 64 + p, 46)]`` (45 dictionary codes, then the unknown
  code 0). The trailing incomplete patch is the natural missing-band case.
* ``documents`` -> raw patch metadata (patch id, S1 name, split, flags),
  then the derived storage paths.
* ``labels`` -> predictions: ``quality`` is the truth, ``toxic`` the
  prediction.
* ``events`` -> run history: ``event_type`` is the run, ``ts`` the epoch
  start, ``value`` the loss.

Every function reads the given tables, so the work grows with them. Each
rule here is mirrored in SQL by :mod:`tessera.plans.oracles`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.common import idiv
from tessera.functions.paths import derive_paths
from tessera.operators import rasters as RA
from tessera.schemas import CODES, LABEL_BAND, S1_BANDS, S2_BANDS

TILE_SIZE = 8
BANDS_PER_PATCH = 6
TESTBED_BANDS = S1_BANDS + S2_BANDS          # position = vec_id mod 6
CODE_RULE = CODES + [0]                      # 46 entries; 0 is not a code
S3_ROOT = "s3://bigearthnet/"
LOCAL_ROOT = "file:/data/bigearthnet/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def patch_id_for(k: Column) -> Column:
    """Testbed patch id of patch number ``k``; every 50th id lacks the
    ``_row_col`` suffix (a regex miss for the tile-id rule)."""
    month = F.lpad((F.pmod(k, F.lit(12)) + 1).cast("string"), 2, "0")
    prefix = F.concat(F.lit("S2A_MSIL2A_2017"), month, F.lit("13T101031_N9999_R022_T33UUP"))
    good = F.concat(prefix, F.lit("_"), idiv(k, 100).cast("string"),
                    F.lit("_"), F.pmod(k, F.lit(100)).cast("string"))
    bad = F.concat(prefix, F.lit("-"), k.cast("string"))
    return F.when(F.pmod(k, F.lit(50)) == 49, bad).otherwise(good)


def s1_name_for(k: Column) -> Column:
    """Sentinel-1 product name of patch ``k``; NULL for every 97th patch."""
    month = F.lpad((F.pmod(k, F.lit(12)) + 1).cast("string"), 2, "0")
    name = F.concat(F.lit("S1A_IW_GRDH_1SDV_2017"), month, F.lit("13T165043_33UUP_"),
                    idiv(k, 100).cast("string"), F.lit("_"),
                    F.pmod(k, F.lit(100)).cast("string"))
    return F.when(F.pmod(k, F.lit(97)) != 13, name)


def split_for(k: Column) -> Column:
    r = F.pmod(k, F.lit(10))
    return F.when(r < 6, "train").when(r < 8, "test").otherwise("validation")


def label_codes_for(k: Column, n: int = TILE_SIZE * TILE_SIZE) -> Column:
    """Reference-map codes of patch ``k`` as array<double> (row-major)."""
    rule = F.array(*[F.lit(c) for c in CODE_RULE])
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda p: F.get(rule, F.pmod(k * n + p, F.lit(len(CODE_RULE))).cast("int"))
                       .cast("double"))


def band_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4 long band tiles: patch_id, band, height, width, dtype, pixels.

    One scan of ``embeddings`` (two columns); the reference map is emitted
    from the same row as the patch's B08 band, so there is no self-union.
    """
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    k = idiv("vec_id", BANDS_PER_PATCH)
    b = F.pmod(F.col("vec_id"), F.lit(BANDS_PER_PATCH)).cast("int")
    band = F.get(F.array(*[F.lit(x) for x in TESTBED_BANDS]), F.col("b"))
    s1_px = F.transform("embedding", lambda v: v.cast("double"))
    s2_px = F.transform("embedding", lambda v: (v.cast("double") * 1000 + 2000).cast("bigint")
                        .cast("double"))
    band_row = F.struct(band.alias("band"),
                        F.when(F.col("b") < 2, "float32").otherwise("uint16").alias("dtype"),
                        F.when(F.col("b") < 2, s1_px).otherwise(s2_px).alias("pixels"))
    label_row = F.struct(F.lit(LABEL_BAND).alias("band"), F.lit("uint16").alias("dtype"),
                         label_codes_for(F.col("k")).alias("pixels"))
    rows = F.when(F.col("b") == BANDS_PER_PATCH - 1, F.array(band_row, label_row)) \
        .otherwise(F.array(band_row))
    return (emb.select(k.alias("k"), b.alias("b"), "embedding")
            .select(patch_id_for(F.col("k")).alias("patch_id"), F.inline(rows))
            .select("patch_id", "band", F.lit(TILE_SIZE).alias("height"),
                    F.lit(TILE_SIZE).alias("width"), "dtype", "pixels"))


def raster_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The band tiles in their own dtypes: a raster instead of an array."""
    return RA.pack(band_tiles(spark, sf_dir))


def copied_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The band tiles, with a second copy of every band of each seventh patch
    number and a third of its VV band."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    k, b = idiv("vec_id", BANDS_PER_PATCH), F.pmod(F.col("vec_id"), F.lit(BANDS_PER_PATCH))
    n = F.when(F.pmod(k, F.lit(7)) != 0, 1).when(b == 0, 3).otherwise(2)
    return emb.select(patch_id_for(k).alias("patch_id"), F.get(F.array(*[F.lit(x) for x in TESTBED_BANDS]), b.cast("int")).alias("band"),
                      "embedding", F.explode(F.sequence(F.lit(1), n)).alias("copy"))


def class_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label, probability) from ``embeddings``: the softmax of a
    row's first ten values (times ten) are the probabilities of classes 0 to 9."""
    scores = F.transform(F.slice("embedding", 1, 10), lambda v: F.exp(v.cast("double") * 10))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"), scores.alias("s"))
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("total", total).select("vec_id", "label", F.transform("s", lambda x: x / F.col("total")).alias("probability"))


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight raw metadata columns of FX1 (plus ``root``), from ``documents``.

    Reads three small columns only; the document text is pruned at the scan.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    k = F.col("doc_id")
    rule = F.array(*[F.lit(str(c)) for c in CODES])
    return docs.select(
        patch_id_for(k).alias("patch_id"),
        F.array(F.get(rule, F.pmod(k, F.lit(len(CODES))).cast("int"))).alias("labels"),
        split_for(k).alias("split"),
        F.col("lang").alias("country"),
        s1_name_for(k).alias("s1_name"),
        F.concat(F.lit("S2A_MSIL2A_"), k.cast("string")).alias("s2v1_name"),
        (F.pmod(F.col("n_chars"), F.lit(7)) == 0).alias("contains_seasonal_snow"),
        (F.pmod(F.col("n_chars"), F.lit(5)) == 0).alias("contains_cloud_or_shadow"),
        F.when(F.pmod(k, F.lit(37)) == 5, LOCAL_ROOT).otherwise(S3_ROOT).alias("root"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1 full metadata (13 columns + path_error) with derived paths.

    The storage root is per row here (a few rows live outside ``s3://``,
    the missing-scheme edge case), so paths are derived with a per-row root.
    """
    raw = raw_metadata(spark, sf_dir)
    return derive_paths(raw, root=F.col("root"), patch_col="patch_id", s1_col="s1_name").drop("root")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label, prediction) from ``labels``: quality vs toxic."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("bigint").alias("label"),
        F.col("toxic").cast("double").alias("prediction"))


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, event_id, started, loss) from ``events``; epochs are numbered
    later by ``ts`` order within the run."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), "event_id", F.col("ts").alias("started"),
        F.col("value").alias("loss"))



def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, value): a log of each run of ``events``, as the jobs print it. Each
    hour of the run is a minute of its fit; counts and accuracy are the run's own."""
    per = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("run")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 0.5).alias("m"),
        F.count_distinct(F.date_trunc("hour", "ts")).alias("hours"))
    clock = F.concat(F.lpad(idiv("hours", 60).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.pmod("hours", F.lit(60)).cast("string"), 2, "0"), F.lit(":07"))
    lines = F.array(
        F.concat(F.lit("Main started at "), clock), F.concat(F.lit("Number of rows in train split: "), F.col("n").cast("string")),
        F.concat(F.lit("Number of rows in test split: "), F.col("m").cast("string")), F.concat(F.lit("Runtime of task Fit pipeline: "), clock),
        F.concat(F.lit("Evaluation done: Accuracy: "), F.round(F.col("m") / F.col("n"), 4).cast("string")), F.lit("Runtime of task Evaluation: 00:02:03"))
    return per.select("run", F.explode(lines).alias("value"))
