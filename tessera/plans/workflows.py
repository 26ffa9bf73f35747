"""The reference's top-level jobs, composed from the operators.

* :func:`classify_pixels`: metadata -> train/test split -> sample -> pixel
  features -> random forest -> held-out accuracy, with stage timings.
* :func:`materialize_patches`: metadata -> per-patch stacked band bytes and
  label-map bytes -> Parquet partitioned by split.
* :func:`prepare_training_set`: metadata -> dense, resized, channels-last
  samples with worker shard, repeat and batch ids.

Each takes DataFrames (metadata with ``patch_id`` and ``split``; FX4 band
tiles, e.g. from :func:`tessera.sources.bandfiles.ingest_band_files`) and
returns frames or a small result record; only the explicit actions (fit,
evaluate, write) run jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import batches as BA
from tessera.operators import labels as L
from tessera.operators import metrics as M
from tessera.operators import models as MO
from tessera.operators import rasters as RA
from tessera.operators import sampling as S
from tessera.operators import tiles as TL
from tessera.operators.funnel import evaluate_both
from tessera.operators.indexing import default_buckets
from tessera.operators.transformers import PixelExtractor
from tessera.plans.runs import StageTimer
from tessera.schemas import RESIZE_TARGET
from tessera.sources.bandsource import Decoder, decode_npy, ingest_rasters
from tessera.sources.sinks import write_patches

SPLITS = ("train", "test")


@dataclass
class Classification:
    model: PipelineModel
    accuracy: float
    accuracy_all: float | None
    counts: dict
    train_patches: int
    test_patches: int
    predictions: DataFrame
    timer: StageTimer = field(repr=False, default=None)


def classify_pixels(meta: DataFrame, tiles: DataFrame, fraction: float | Mapping[str, float] = 1.0,
                    seed: int = 42, num_trees: int = 20, max_depth: int = 5,
                    label_target: str = "CLASS", run: str = "classify") -> Classification:
    """Train on the train split, evaluate on the test split.

    Sampling is the layout-independent hash sampler (same rows on any
    cluster size); the split counts are one aggregation; the forest's input
    is cached for the fit only; evaluation is one pass over the test
    pixels, which also counts what each stage leaves (``counts``) and so gives accuracy over
    the pixels that survive and over all of them."""
    timer = StageTimer(run)
    fr = dict(fraction) if isinstance(fraction, Mapping) else {s: float(fraction) for s in SPLITS}
    chosen = S.stratified_sample(S.filter_isin(meta.select("patch_id", "split"), "split", SPLITS),
                                 "split", fr, ["patch_id"], seed=seed)
    with timer.stage("count"):
        counts = {r["split"]: r["n"] for r in M.split_counts(chosen).collect()}
    pipeline = MO.build_pipeline(PixelExtractor().with_tiles(tiles), seed=seed, num_trees=num_trees,
                                 max_depth=max_depth, label_target=label_target)
    with timer.stage("fit"):
        model = MO.fit(pipeline, chosen.filter(F.col("split") == "train"))
    preds = MO.predict(model, chosen.filter(F.col("split") == "test"))
    with timer.stage("evaluation"):
        found = evaluate_both(model, chosen.filter(F.col("split") == "test"))
    return Classification(model, found["accuracy"] or 0.0, found["accuracy_all"], found, counts.get("train", 0), counts.get("test", 0), preds, timer)


def classify_files(spark: SparkSession, roots: str | Sequence[str], meta: DataFrame, fraction: float | Mapping[str, float] = 1.0,
                   seed: int = 42, decoder: Decoder = decode_npy, **kw) -> Classification:
    """The same from band files: the metadata (patch_id, s1_name, split) is
    sampled first, and only the files of the sample are opened."""
    fr = dict(fraction) if isinstance(fraction, Mapping) else {s: float(fraction) for s in SPLITS}
    chosen = S.stratified_sample(S.filter_isin(meta, "split", SPLITS), "split", fr, ["patch_id"], seed=seed)
    return classify_pixels(chosen, ingest_rasters(spark, roots, chosen, decoder), fraction=1.0, seed=seed, **kw)


def materialize_patches(meta: DataFrame, tiles: DataFrame, height: int, width: int,
                        output_path: str | None = None) -> DataFrame:
    """Per patch: ``bands`` (S1 then S2 stack, bytes), ``label_map`` (bytes),
    dtype/shape columns and ``missing_bands``; written partitioned by split
    when ``output_path`` is given. All or nothing per patch: a missing or
    wrong-size band gives NULL bytes and is listed in ``missing_bands``."""
    wanted = S.filter_isin(meta.select("patch_id", "split"), "split", SPLITS)
    tl = tiles.join(wanted.select("patch_id"), "patch_id", "left_semi")
    if "raster" in tiles.columns:
        return _materialize_rasters(wanted, tl, height, width, output_path)
    # one pivot (one shuffle of the tiles); everything else is narrow
    patches = (TL.pivot_bands(tl).join(wanted, "patch_id", "right")
               .withColumn("missing_bands", TL.missing_from_arrays(size=height * width)))
    stack = TL.stack_bytes(patches, height, width, keep=["split", "missing_bands", "label"])
    out = TL.stack_bytes(stack, height, width, channels=("label",), out="label_map", with_header=False,
                         keep=["split", "missing_bands", "bands", "dtype", "channels", "height", "width"])
    if output_path:
        write_patches(out, output_path)
    return out


def _materialize_rasters(wanted: DataFrame, tiles: DataFrame, height: int, width: int, output_path: str | None) -> DataFrame:
    """The same from typed rasters: stack and label map in the rasters' own
    dtypes, both from one pass, and the reason where a patch is rejected."""
    patches = RA.assemble_rasters(tiles).join(wanted, "patch_id", "right")
    fields = [TL.PIXEL_FIELD[b] for b in TL.DEFAULT_BANDS]
    absent = F.array_compact(F.array(*[
        F.when(F.col(f).isNull() | (F.col(f)["planes"] != 1) | (F.col(f)["height"] != height) | (F.col(f)["width"] != width), F.lit(b))
        for b, f in zip(TL.DEFAULT_BANDS, fields)]))
    out = RA.stack(patches.withColumn("missing_bands", absent), height=height, width=width, keep=("split", "missing_bands", "n_copies"),
                   also={"label_map": ("label",)})
    if output_path:
        write_patches(out, output_path)
    return out


def prepare_training_set(meta: DataFrame, tiles: DataFrame, in_size: int, out_size: int = RESIZE_TARGET,
                         *, n_workers: int, local_batch_size: int, repeats: int = 2,
                         fraction: float | None = None, seed: int = 42,
                         channels: Sequence[str] = ("VV", "VH", "B", "G", "R", "NIR"),
                         resize_engine: str = "arrow", check_workers: bool = False) -> DataFrame:
    """Dense samples per train/test patch: image (out x out x C, bilinear,
    channels last, float), label map (out x out, nearest, dense class ids),
    plus shard / repeat / batch ids for ``n_workers`` workers. The batch is
    the global batch (local x workers) as in the reference input pipeline.
    A patch with a missing band keeps its row with NULL arrays and
    ``complete = false`` (all or nothing, never a partial stack). With
    ``check_workers`` the worker-count guard runs first (an action over the
    patch keys only) and raises if a split does not fill every shard."""
    wanted = S.filter_isin(meta.select("patch_id", "split"), "split", SPLITS)
    nb = default_buckets(meta.sparkSession)
    if fraction is not None:
        wanted = S.exact_sample(wanted, "split", fraction, ["patch_id"], seed=seed, n_buckets=nb,
                                n_strata_bound=len(SPLITS))
    ordered = BA.shard(BA.element_order(wanted, "split", ["patch_id"], seed=seed, n_buckets=nb,
                                        n_groups_bound=len(SPLITS)), n_workers)
    if check_workers:
        BA.check_shards(ordered, n_workers, "split")
    # ids meet the raw arrays; a repeat is a copy of the resized row in the same task
    patches = TL.pivot_bands(tiles.join(wanted.select("patch_id"), "patch_id", "left_semi")).join(ordered, "patch_id", "right")
    ids = [c for c in ordered.columns if c != "patch_id"]
    src = patches.select("patch_id", *ids, *channels, L.encode_dense_array("label").cast("array<float>").alias("label_map"))
    # one Arrow pass: bilinear for the image bands, nearest for class ids
    resized = TL.resize_frame(src, {**{c: "bilinear" for c in channels}, "label_map": "nearest"},
                              in_size, in_size, out_size, out_size, engine=resize_engine)
    dense = resized.select("patch_id", *ids, TL.interleave(tuple(channels)).alias("image"), F.col("label_map").alias("label"))
    seq = BA.batch(BA.repeat(dense, repeats, group_cols=("split", "shard")), BA.global_batch_size(local_batch_size, n_workers))
    return seq.select(
        "patch_id", "split", "shard", "rep", "pos", "batch_id", "slot", "image", "label",
        (F.col("image").isNotNull() & F.col("label").isNotNull()).alias("complete"),
        F.lit(out_size).alias("height"), F.lit(out_size).alias("width"), F.lit(len(channels)).alias("channels"))
