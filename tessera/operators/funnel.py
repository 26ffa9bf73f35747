"""How many pixels each step of the classification leaves, and accuracy over
both denominators: the pixels that survive, and all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.schemas import FEATURE_COLUMNS


def is_valid(features: Sequence[str] = FEATURE_COLUMNS) -> Column:
    """No feature is NULL or NaN (infinite ones stay), as in the assembly."""
    ok = F.lit(True)
    for c in features:
        ok = ok & F.col(c).isNotNull() & ~F.coalesce(F.isnan(F.col(c).cast("double")), F.lit(False))
    return ok


def pixel_counts(indexed: DataFrame, dictionary: DataFrame, by: str = "split", key: str = "patch_id", label_col: str = "label",
                 features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Per ``by``: n_patches, n_pixels before the recode, n_known after it (the
    label is in the dictionary), n_valid after the assembly (and no feature is
    undefined). ``indexed`` is the pixel table with its indices. One aggregation per (by, patch), so nothing is counted
    distinct, then one over patches."""
    from tessera.operators.labels import _guarded_broadcast
    codes = _guarded_broadcast(dictionary.select(F.col("ID").cast("bigint").alias("_code")).distinct(), None)
    seen = indexed.join(codes, indexed[label_col] == F.col("_code"), "left")
    known = F.col("_code").isNotNull()
    per_patch = seen.groupBy(by, key).agg(F.count(F.lit(1)).alias("n"), F.count_if(known).alias("known"), F.count_if(known & is_valid(features)).alias("valid"))
    return per_patch.groupBy(by).agg(F.count(F.lit(1)).alias("n_patches"), F.sum("n").alias("n_pixels"), F.sum("known").alias("n_known"),
                                     F.sum("valid").alias("n_valid"))


def evaluate_both(model: PipelineModel, test: DataFrame) -> dict:
    """Action, one pass over ``test``: n_pixels, n_known, n_valid, n_correct,
    accuracy (over the pixels that survive) and accuracy_all (over all of
    them). The counts are observed where each stage of the model puts its
    rows out, while the predictions are counted."""
    from tessera.operators.transformers import FeatureAssembler, LabelRecoder, PixelExploder
    points = {PixelExploder: "n_pixels", LabelRecoder: "n_known", FeatureAssembler: "n_valid"}
    seen: dict[str, Observation] = {}
    df = test
    for stage in model.stages:
        df = stage.transform(df)
        name = points.get(type(stage)) if isinstance(stage, Transformer) else None
        if name:
            seen[name] = Observation(name)
            df = df.observe(seen[name], F.count(F.lit(1)).alias("n"))
    hit = F.count_if(F.col("label").cast("double") == F.col("prediction"))
    found = {"n_correct": df.agg(hit.alias("hit")).first()["hit"], **{k: o.get["n"] for k, o in seen.items()}}
    for name, whole in (("accuracy", "n_valid"), ("accuracy_all", "n_pixels")):
        found[name] = found["n_correct"] / found[whole] if found.get(whole) else None
    return found
