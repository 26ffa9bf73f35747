"""The registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
driver's tables, composed from the library operators. Array results are
flattened (one row per element) so results compare type-neutrally."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import indices as I
from tessera.functions import paths as PA
from tessera.operators import batches as BA
from tessera.operators import funnel as FU
from tessera.operators import labels as L
from tessera.operators import metrics as M
from tessera.operators import models as MO
from tessera.operators import rasters as RA
from tessera.operators import sampling as S
from tessera.operators import tiles as TL
from tessera.operators.assembly import assemble
from tessera.operators.indexing import default_buckets
from tessera.operators.transformers import FeatureAssembler, PixelExtractor
from tessera.plans import params as P
from tessera.plans import runs as RU
from tessera.plans import testbed as TB
from tessera.schemas import CODES, FEATURE_COLUMNS, INDEX_COLUMNS, S2_ALL_BANDS
from tessera.sources import metadata as MD

Query = Callable[[SparkSession, str], DataFrame]
TILE = TB.TILE_SIZE

# ---------------------------------------------------------------------------
# Shared sub-plans
# ---------------------------------------------------------------------------


def patch_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX5 per-patch arrays of the testbed tiles (one shuffle on patch_id)."""
    return TL.pivot_bands(TB.band_tiles(spark, sf_dir))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX6 pixel table: patch_id, pos, VV, VH, B, G, R, NIR, label."""
    return TL.explode_pixels(patch_arrays(spark, sf_dir))


def train_test_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.filter_isin(TB.metadata(spark, sf_dir), "split", P.SPLITS)


def ordered_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train/test patches with their hash-order index and worker shard."""
    meta = train_test_meta(spark, sf_dir).select("patch_id", "split")
    ordered = BA.element_order(meta, "split", ["patch_id"], seed=P.SEED,
                               n_buckets=default_buckets(spark, P.INDEX_BUCKETS),
                               n_groups_bound=len(P.SPLITS))
    return BA.shard(ordered, P.N_SHARDS)


# ---------------------------------------------------------------------------
# Scans, filters, projections
# ---------------------------------------------------------------------------


def q_scan_pruned(spark, sf_dir):
    return TB.metadata(spark, sf_dir).select("split", "s1_path", "s2_path", "label_path")


def q_filter_isin(spark, sf_dir):
    return train_test_meta(spark, sf_dir).select("patch_id", "split")


def q_split_counts(spark, sf_dir):
    return M.split_counts(train_test_meta(spark, sf_dir)).select("split", "n")


def q_project(spark, sf_dir):
    return TB.metadata(spark, sf_dir).select("patch_id", "split", "country", "contains_seasonal_snow",
                                             "contains_cloud_or_shadow")


# ---------------------------------------------------------------------------
# Paths
# ---------------------------------------------------------------------------


def q_derive_paths(spark, sf_dir):
    return TB.metadata(spark, sf_dir).select("patch_id", "patch_id_path", "patch_id_path_s1",
                                             "s1_path", "s2_path", "label_path", "path_error")


def q_strip_scheme(spark, sf_dir):
    m = TB.metadata(spark, sf_dir)
    return m.select("patch_id", PA.strip_scheme("s1_path").alias("s1"), PA.strip_scheme("s2_path").alias("s2"),
                    PA.strip_scheme("label_path").alias("label"))


def q_scheme_prepend(spark, sf_dir):
    m = TB.metadata(spark, sf_dir)
    return m.select("patch_id", PA.add_scheme(PA.strip_scheme("s2_path")).alias("s2"))


def q_path_string(spark, sf_dir):
    m = TB.metadata(spark, sf_dir)
    return m.select("patch_id", "split", PA.paths_string("s1_path", "s2_path", "label_path").alias("paths"))


def q_paths_array(spark, sf_dir):
    m = TB.metadata(spark, sf_dir)
    arr = PA.paths_array(PA.strip_scheme("s1_path"), PA.strip_scheme("s2_path"), PA.strip_scheme("label_path"),
                         F.col("patch_id"))
    return m.select("patch_id", F.posexplode(arr).alias("pos", "path")) \
        .select("patch_id", F.col("pos").cast("int").alias("pos"), "path")


def q_band_paths(spark, sf_dir):
    m = TB.metadata(spark, sf_dir).select(
        "patch_id", PA.paths_string("s1_path", "s2_path", "label_path").alias("paths"))
    return PA.band_file_rows(m, "paths", keep=["patch_id"]).select("patch_id", "sensor", "band", "path")


def q_band_filter(spark, sf_dir):
    m = TB.metadata(spark, sf_dir).select("patch_id", "s2_path")
    names = F.array(*[F.lit(b) for b in S2_ALL_BANDS])
    listing = m.select("patch_id", F.explode(F.transform(
        names, lambda b: F.concat(F.col("s2_path"), F.col("patch_id"), F.lit("_"), b, F.lit(".tif"))))
        .alias("path"))
    return listing.filter(PA.is_s2_band_file("path")).select("patch_id", PA.band_name("path").alias("band"), "path")


# ---------------------------------------------------------------------------
# Sampling
# ---------------------------------------------------------------------------


def q_stratified_sample(spark, sf_dir):
    meta = train_test_meta(spark, sf_dir).select("patch_id", "split")
    return S.stratified_sample(meta, "split", P.SAMPLE_FRACTIONS, ["patch_id"], seed=P.SEED)


def q_exact_sample(spark, sf_dir):
    meta = train_test_meta(spark, sf_dir).select("patch_id", "split")
    return S.exact_sample(meta, "split", P.EXACT_FRACTION, ["patch_id"], seed=P.SEED,
                          n_buckets=default_buckets(spark, P.INDEX_BUCKETS), n_strata_bound=len(P.SPLITS))


def q_limit_k(spark, sf_dir):
    meta = train_test_meta(spark, sf_dir).select("patch_id", "split")
    return S.limit_k(meta, P.LIMIT_K, ["patch_id"])


# ---------------------------------------------------------------------------
# Tiles and pixels
# ---------------------------------------------------------------------------


def _array_sum(c: str):
    return F.aggregate(F.col(c), F.lit(0).cast("bigint"), lambda a, x: a + x)


def q_bands_pivot(spark, sf_dir):
    p = patch_arrays(spark, sf_dir)
    present = sum(F.col(c).isNotNull().cast("int") for c in ("VV", "VH", "B", "G", "R", "NIR", "label"))
    return p.select("patch_id", present.alias("n_bands"), F.size("VV").alias("vv_size"),
                    F.size("label").alias("label_size"), _array_sum("B").alias("b_sum"),
                    _array_sum("G").alias("g_sum"), _array_sum("R").alias("r_sum"),
                    _array_sum("NIR").alias("nir_sum"), F.array_max("VV").alias("vv_max"),
                    F.array_min("VH").alias("vh_min"))


def q_missing_bands(spark, sf_dir):
    mb = TL.missing_bands(TB.band_tiles(spark, sf_dir))
    return mb.select("patch_id", F.explode("missing_bands").alias("band"))


def q_explode_pixels(spark, sf_dir):
    return pixels(spark, sf_dir)


def q_indices(spark, sf_dir):
    return I.with_indices(pixels(spark, sf_dir)).select("patch_id", "pos", *INDEX_COLUMNS)


def q_ndwi_normalized(spark, sf_dir):
    return I.with_indices(pixels(spark, sf_dir), I.NDWI_NORMALIZED).select("patch_id", "pos", "NDWI")


# ---------------------------------------------------------------------------
# Labels
# ---------------------------------------------------------------------------


def q_label_recode(spark, sf_dir):
    out = L.recode_labels(pixels(spark, sf_dir), L.label_dictionary(spark), target="ID_NEW")
    return out.select("patch_id", "pos", "label")


def q_label_unmatched(spark, sf_dir):
    return L.unmatched_labels(pixels(spark, sf_dir), L.label_dictionary(spark))


def q_label_encode_dense(spark, sf_dir):
    p = patch_arrays(spark, sf_dir).filter(F.col("label").isNotNull())
    z = F.arrays_zip(F.col("label").alias("code"), L.encode_dense_array("label").alias("class_id"))
    return p.select("patch_id", F.posexplode(z).alias("pos", "_z")).select(
        "patch_id", F.col("pos").cast("int").alias("pos"), F.col("_z.code").alias("code"),
        F.col("_z.class_id").alias("class_id"))


def q_features(spark, sf_dir):
    px = I.with_indices(pixels(spark, sf_dir))
    rec = L.recode_labels(px, L.label_dictionary(spark), target="CLASS")
    feats = FeatureAssembler(keepCols=["patch_id", "pos"]).transform(rec)
    arr = vector_to_array("features")
    return feats.select("patch_id", "pos", *[arr[i].alias(c) for i, c in enumerate(FEATURE_COLUMNS)], "label")


# ---------------------------------------------------------------------------
# Tile ops: stack, interleave, resize, shape
# ---------------------------------------------------------------------------


def patch_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The testbed's patches with a raster per band, each in its own dtype."""
    return RA.assemble_rasters(TB.raster_tiles(spark, sf_dir))


def q_stack_bands(spark, sf_dir):
    st = RA.stack(patch_rasters(spark, sf_dir))
    return st.select("patch_id", "dtype", "channels", "height", "width",
                     F.octet_length("bands").alias("n_bytes"))


def q_label_bytes(spark, sf_dir):
    st = RA.label_raster(patch_rasters(spark, sf_dir))
    return st.select("patch_id", "dtype", "channels", "height", "width",
                     F.octet_length("label_map").alias("n_bytes"))


def q_stack_values(spark, sf_dir):
    """The samples that the stacks' bytes decode to."""
    return RA.unstack(RA.stack(patch_rasters(spark, sf_dir)), keep=("dtype",))


def q_label_values(spark, sf_dir):
    return RA.unstack(RA.label_raster(patch_rasters(spark, sf_dir)), data_col="label_map", keep=("dtype",)).drop("channel")


def q_raster_pixels(spark, sf_dir):
    """The pixel table straight from typed rasters."""
    return RA.raster_pixels(patch_rasters(spark, sf_dir))


def q_assemble_copies(spark, sf_dir):
    """Audit of the assembly: bands found and copies left out, per patch."""
    bands = TB.TESTBED_BANDS
    wide = assemble(TB.copied_tiles(spark, sf_dir), "embedding", bands, tie="copy")
    n_bands = sum(F.col(b).isNotNull().cast("int") for b in bands)
    return wide.select("patch_id", n_bands.alias("n_bands"), "n_copies", F.get("B08", F.lit(0)).cast("double").alias("b08_first"))


def q_rejects(spark, sf_dir):
    """Patches whose rasters cannot be laid over each other, with the reason.
    Every fifth patch's B04 is cut to half its height first."""
    rows = TB.band_tiles(spark, sf_dir)
    cut = (F.col("band") == "B04") & (F.pmod(F.crc32(F.col("patch_id").cast("binary")), F.lit(5)) == 0)
    half = TILE // 2
    rows = rows.withColumns({"pixels": F.when(cut, F.slice("pixels", 1, half * TILE)).otherwise(F.col("pixels")),
                             "height": F.when(cut, half).otherwise(F.col("height"))})
    patches = RA.assemble_rasters(RA.pack(rows))
    return RA.split_rejects(patches, ("VV", "VH", "B", "G", "R", "NIR", "label")).filter("reject_reason IS NOT NULL").select("patch_id", "reject_reason")


def q_interleave(spark, sf_dir):
    p = patch_arrays(spark, sf_dir).select("patch_id", TL.interleave().alias("image"))
    return p.select("patch_id", F.posexplode("image").alias("idx", "value")) \
        .select("patch_id", F.col("idx").cast("int").alias("idx"), "value")


def q_resize_nearest(spark, sf_dir):
    p = patch_arrays(spark, sf_dir).filter(F.col("label").isNotNull())
    dense = L.encode_dense_array("label").cast("array<float>")
    r = p.select("patch_id", TL.resize_nearest(dense, TILE, TILE, P.RESIZE_OUT, P.RESIZE_OUT).alias("r"))
    return r.select("patch_id", F.posexplode("r").alias("pos", "value")) \
        .select("patch_id", F.col("pos").cast("int").alias("pos"), "value")


def q_resize_bilinear(spark, sf_dir):
    t = TB.band_tiles(spark, sf_dir).filter(F.col("band") != "reference_map").select("patch_id", "band", F.col("pixels").alias("r"))
    r = TL.resize_frame(t, {"r": "bilinear"}, TILE, TILE, P.RESIZE_OUT, P.RESIZE_OUT)
    return r.select("patch_id", "band", F.posexplode("r").alias("pos", "v")).select(
        "patch_id", "band", F.col("pos").cast("int").alias("pos"),
        F.round(F.col("v").cast("double"), 4).alias("value"))


def q_shape_check(spark, sf_dir):
    p = patch_arrays(spark, sf_dir).select("patch_id", TL.interleave().alias("image"))
    n_ch = 6
    return p.select("patch_id", F.size("image").alias("n_values"),
                    F.lit(TILE * TILE * n_ch).alias("expected"),
                    TL.shape_check(F.col("image"), TILE, TILE, n_ch).alias("ok"))


# ---------------------------------------------------------------------------
# Metrics
# ---------------------------------------------------------------------------


def q_confusion(spark, sf_dir):
    return M.confusion(TB.predictions(spark, sf_dir))


def q_accuracy(spark, sf_dir):
    return M.accuracy(TB.predictions(spark, sf_dir))


def q_iou_per_class(spark, sf_dir):
    return M.iou_per_class(TB.predictions(spark, sf_dir), smooth=P.SMOOTH)


def q_iou_mean(spark, sf_dir):
    return M.iou_mean(TB.predictions(spark, sf_dir), smooth=P.SMOOTH)


def q_jaccard_loss(spark, sf_dir):
    return M.jaccard_loss(TB.predictions(spark, sf_dir), smooth=P.SMOOTH)


def q_soft_iou(spark, sf_dir):
    per = M.soft_iou_per_class(TB.class_probabilities(spark, sf_dir), smooth=P.SMOOTH)
    return per.select("class_id", *[F.round(c, 6).alias(c) for c in ("intersection", "union", "iou")])


def q_soft_jaccard(spark, sf_dir):
    loss = M.soft_jaccard_loss(TB.class_probabilities(spark, sf_dir), smooth=P.SMOOTH, ignore_index=P.SOFT_IGNORE)
    return loss.select("n_classes", F.round("iou_score", 6).alias("iou_score"), F.round("jaccard_loss", 6).alias("jaccard_loss"))


def q_pixel_counts(spark, sf_dir):
    """Pixels before the recode, after it and after the assembly, per split."""
    px = I.with_indices(pixels(spark, sf_dir))
    return FU.pixel_counts(px.join(train_test_meta(spark, sf_dir).select("patch_id", "split"), "patch_id"), L.label_dictionary(spark))


def q_best_epoch(spark, sf_dir):
    # the number of runs is data, not a proven bound: no broadcast hint, AQE
    # broadcasts the per-run winners from their measured size
    return M.best_epoch_by_time(TB.run_history(spark, sf_dir))


def q_run_metrics(spark, sf_dir):
    s = RU.run_summary(TB.run_history(spark, sf_dir))
    return s.withColumn("mean_loss", F.round("mean_loss", 6))


def q_run_speed_ups(spark, sf_dir):
    s = RU.speed_ups(RU.run_summary(TB.run_history(spark, sf_dir)), P.BASELINE_RUN)
    return s.select("run", "seconds", F.round("speed_up", 6).alias("speed_up"))


def q_run_logs(spark, sf_dir):
    """What the parser reads from the runs' logs, with the ratio of fit times."""
    parsed = RU.parse_run_log(TB.run_log(spark, sf_dir))
    ratio = RU.speed_ups(parsed.withColumnRenamed("fit_seconds", "seconds"), P.BASELINE_RUN)
    return ratio.select("run", "train_rows", "test_rows", F.col("seconds").alias("fit_seconds"), "evaluation_seconds", "main_seconds",
                        "accuracy", F.round("speed_up", 6).alias("speed_up"))


# ---------------------------------------------------------------------------
# Training-set preparation
# ---------------------------------------------------------------------------


def q_shards(spark, sf_dir):
    return ordered_elements(spark, sf_dir).select("patch_id", "split", "idx", "shard", "shard_pos")


def _repeated(spark, sf_dir):
    return BA.repeat(ordered_elements(spark, sf_dir), P.N_REPEATS, group_cols=("split", "shard"))


def q_repeat(spark, sf_dir):
    return _repeated(spark, sf_dir).select("patch_id", "split", "shard", "rep", "pos")


def q_batches(spark, sf_dir):
    b = BA.batch(_repeated(spark, sf_dir), P.BATCH_SIZE)
    return b.select("patch_id", "split", "shard", "rep", "pos", "batch_id", "slot")


def q_training_samples(spark, sf_dir):
    """Rows only: one dense sample per train/test patch — image (12x12x6,
    bilinear, channels last) and label map (12x12x1, nearest, dense ids),
    keyed by split and shard. A patch without tiles or with a missing band
    keeps its row with ``complete = false``."""
    elems = ordered_elements(spark, sf_dir)
    p = patch_arrays(spark, sf_dir).join(elems, "patch_id", "right")
    out = P.RESIZE_OUT
    bands = ("VV", "VH", "B", "G", "R", "NIR")
    src = p.select("patch_id", "split", "shard", "idx", *bands,
                   L.encode_dense_array("label").cast("array<float>").alias("label_map"))
    r = TL.resize_frame(src, {**{c: "bilinear" for c in bands}, "label_map": "nearest"}, TILE, TILE, out, out)
    dense = r.select("patch_id", "split", "shard", "idx", TL.interleave(bands).alias("image"),
                     F.col("label_map").alias("label"))
    return dense.select("patch_id", "split", "shard", "idx", "image", "label",
                        (F.col("image").isNotNull() & F.col("label").isNotNull()).alias("complete"),
                        F.lit(out).alias("height"), F.lit(out).alias("width"), F.lit(6).alias("channels"))


def q_training_values(spark, sf_dir):
    """The training samples' values, one row each; a row without a value for an incomplete sample."""
    t = q_training_samples(spark, sf_dir)
    ids = ["patch_id", "split", "shard", "idx", "complete"]
    parts = [t.select(*ids, F.lit(kind).alias("kind"), F.posexplode_outer(kind).alias("pos", "value")) for kind in ("image", "label")]
    return parts[0].unionByName(parts[1]).select(*ids, "kind", F.col("pos").cast("int").alias("pos"), F.round(F.col("value").cast("double"), 4).alias("value"))


# ---------------------------------------------------------------------------
# Pixel classification pipeline
# ---------------------------------------------------------------------------


def q_rf_pipeline(spark, sf_dir):
    """Rows only: fit the forest on train-split pixels, predict test pixels."""
    meta = train_test_meta(spark, sf_dir).select("patch_id", "split")
    tiles = TB.band_tiles(spark, sf_dir)
    pipeline = MO.build_pipeline(PixelExtractor().with_tiles(tiles), seed=P.SEED)
    model = MO.fit(pipeline, meta.filter(F.col("split") == "train"))
    return MO.predict(model, meta.filter(F.col("split") == "test"))


def q_forest_checked(spark, sf_dir):
    """The forest on labels that a feature determines must pass a bound that it
    fails on labels drawn by hash; its input has a fixed layout."""
    px = pixels(spark, sf_dir).join(train_test_meta(spark, sf_dir).select("patch_id", "split"), "patch_id")
    low, high = P.RED_STEPS
    by_red = F.when(F.col("R") < low, 0).when(F.col("R") < high, 1).otherwise(2)
    by_hash = F.pmod(F.crc32(F.concat_ws(":", "patch_id", F.col("pos").cast("string")).cast("binary")), F.lit(3))
    codes = F.array(*[F.lit(c) for c in CODES[:3]])
    out = None
    for kind, cls, bound in (("determined", by_red, P.FOREST_BOUND), ("scrambled", by_hash, P.SCRAMBLED_BOUND)):
        labelled = px.withColumn("label", F.get(codes, cls.cast("int")).cast("bigint"))
        model = MO.fit(MO.pixel_pipeline(seed=P.SEED), labelled.filter("split = 'train'"), layout=P.FOREST_LAYOUT)
        found = M.accuracy(MO.predict(model, labelled.filter("split = 'test'")))
        row = found.select(F.lit(kind).alias("labels"), F.col("n").alias("n_test"), (F.col("accuracy") > bound).alias("passes"))
        out = row if out is None else out.unionByName(row)
    return out


def q_scan_pushed(spark, sf_dir):
    """A pruned Parquet scan with its filter pushed into the reader."""
    schema = "o_orderkey long, o_orderstatus string, o_totalprice double"
    return MD.read_metadata(spark, f"{sf_dir.rstrip('/')}/orders.parquet", schema, P.ORDER_STATUS, "o_orderstatus")


QUERIES: dict[str, Query] = {
    "scan_pruned": q_scan_pruned,
    "filter_isin": q_filter_isin,
    "split_counts": q_split_counts,
    "project": q_project,
    "derive_paths": q_derive_paths,
    "strip_scheme": q_strip_scheme,
    "scheme_prepend": q_scheme_prepend,
    "path_string": q_path_string,
    "paths_array": q_paths_array,
    "band_paths": q_band_paths,
    "band_filter": q_band_filter,
    "stratified_sample": q_stratified_sample,
    "exact_sample": q_exact_sample,
    "limit_k": q_limit_k,
    "bands_pivot": q_bands_pivot,
    "missing_bands": q_missing_bands,
    "explode_pixels": q_explode_pixels,
    "indices": q_indices,
    "ndwi_normalized": q_ndwi_normalized,
    "label_recode": q_label_recode,
    "label_unmatched": q_label_unmatched,
    "label_encode_dense": q_label_encode_dense,
    "features": q_features,
    "stack_bands": q_stack_bands,
    "label_bytes": q_label_bytes,
    "stack_values": q_stack_values,
    "label_values": q_label_values,
    "raster_pixels": q_raster_pixels,
    "assemble_copies": q_assemble_copies,
    "rejects": q_rejects,
    "interleave": q_interleave,
    "resize_nearest": q_resize_nearest,
    "resize_bilinear": q_resize_bilinear,
    "shape_check": q_shape_check,
    "confusion": q_confusion,
    "accuracy": q_accuracy,
    "iou_per_class": q_iou_per_class,
    "iou_mean": q_iou_mean,
    "jaccard_loss": q_jaccard_loss,
    "best_epoch": q_best_epoch,
    "shards": q_shards,
    "repeat": q_repeat,
    "batches": q_batches,
    "run_metrics": q_run_metrics,
    "training_samples": q_training_samples,
    "rf_pipeline": q_rf_pipeline,
    "soft_iou": q_soft_iou,
    "soft_jaccard": q_soft_jaccard,
    "pixel_counts": q_pixel_counts,
    "run_speed_ups": q_run_speed_ups,
    "run_logs": q_run_logs,
    "training_values": q_training_values,
    "forest_checked": q_forest_checked,
    "scan_pushed": q_scan_pushed,
}
