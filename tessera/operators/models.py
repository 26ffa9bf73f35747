"""Pixel classification: pipeline assembly, fitting, inference, evaluation."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.transformers import (FeatureAssembler, IndexCalculator, LabelRecoder, PixelExploder,
                                            PixelExtractor)


def build_pipeline(extractor: PixelExtractor, key: str = "patch_id", label_target: str = "CLASS",
                   ndwi_variant: str = "as_written", num_trees: int = 20, max_depth: int = 5,
                   max_bins: int = 32, seed: int = 42, keep_cols: list[str] | None = None) -> Pipeline:
    """extract -> explode -> indices -> recode -> assemble -> forest.

    Forest defaults are the library defaults (20 trees, depth 5, 32 bins);
    the seed makes bagging repeatable on a fixed layout."""
    keep = [key, "pos", *(keep_cols or [])]
    stages = [
        extractor,
        PixelExploder(keyCol=key),
        IndexCalculator(ndwiVariant=ndwi_variant),
        LabelRecoder(target=label_target),
        FeatureAssembler(keepCols=keep),
    ]
    stages.append(RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees,
                                         maxDepth=max_depth, maxBins=max_bins, seed=seed))
    return Pipeline(stages=stages)


def pixel_pipeline(label_target: str = "CLASS", num_trees: int = 20, max_depth: int = 5, max_bins: int = 32, seed: int = 42,
                   keep_cols: tuple[str, ...] = ("patch_id", "pos")) -> Pipeline:
    """The same from a pixel table: indices -> recode -> assemble -> forest."""
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins, seed=seed)
    return Pipeline(stages=[IndexCalculator(), LabelRecoder(target=label_target), FeatureAssembler(keepCols=list(keep_cols)), forest])


def fit(pipeline: Pipeline, train: DataFrame, persist: bool = True, layout: int | None = None,
        layout_keys: tuple[str, ...] = ("patch_id", "pos")) -> PipelineModel:
    """Fit the pipeline. With ``persist`` the feature stages run once, their
    output (the forest's input, which it scans several times) is kept in
    memory and disk for the fit only and released afterwards. The result has
    the same stages as ``pipeline.fit``'s. Forest bagging depends on the
    physical layout of its input: ``layout`` deals the features into that many partitions by
    the first of ``layout_keys``, sorted by all, so that the same rows give the same
    trees whatever the cluster. Without it individual trees may differ."""
    *prep, last = pipeline.getStages()
    if not persist or not all(isinstance(s, Transformer) for s in prep):
        return pipeline.fit(train)
    feats = train
    for s in prep:
        feats = s.transform(feats)
    if layout:
        feats = feats.repartition(layout, layout_keys[0]).sortWithinPartitions(*layout_keys)
    # The forest reads features and labels alone; keys are for the layout.
    feats = feats.select(last.getFeaturesCol(), last.getLabelCol()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = last.fit(feats)
    finally:
        feats.unpersist()
    return PipelineModel(stages=[*prep, model])


def predict(model: PipelineModel, test: DataFrame, keep: tuple[str, ...] = ("patch_id", "pos")) -> DataFrame:
    """Lazy inference: (keep..., label, prediction)."""
    out = model.transform(test)
    return out.select(*[c for c in keep if c in out.columns], F.col("label").cast("bigint").alias("label"),
                      "prediction")


def evaluate_accuracy(preds: DataFrame) -> float:
    """Action: overall accuracy with the MLlib evaluator."""
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                             metricName="accuracy").evaluate(preds)
