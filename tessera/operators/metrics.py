"""Evaluation metrics as distributed aggregations.

All metrics derive from the confusion matrix ``(label, prediction, n)``,
whose size is classes^2 regardless of the number of pixels: one partial +
final hash aggregation, then tiny follow-up math.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMOOTH = 1e-5


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split in one aggregation (instead of one count job each)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def confusion(preds: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(label bigint, prediction bigint, n bigint)."""
    return preds.groupBy(F.col(label_col).cast("bigint").alias("label"),
                         F.col(pred_col).cast("bigint").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def accuracy(preds: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """One row: n, n_correct, accuracy = correct / total (NULL on no rows)."""
    correct = (F.col(label_col).cast("double") == F.col(pred_col).cast("double")).cast("bigint")
    return preds.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(correct), F.lit(0)).alias("n_correct")) \
        .withColumn("accuracy", F.try_divide(F.col("n_correct").cast("double"), F.col("n").cast("double")))


def iou_per_class(preds: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                  smooth: float = SMOOTH, num_classes: int | None = None, ignore_index: int | None = None) -> DataFrame:
    """Hard IoU per class c: (|l=c & p=c| + s) / (|l=c | p=c| + s).
    Rows labelled ``ignore_index`` are left out, and that class with them.

    Predictions are counted by (label, prediction) first, map-side; each of
    those <= classes squared counts then contributes to its label class
    (label count, true positives) and to its predicted class (prediction
    count). A NULL label or prediction is no class. Classes are those seen, or 0..num_classes-1 when given
    (a class never seen scores s / s = 1, the smoothed convention)."""
    pairs = (preds.groupBy(F.col(label_col).cast("bigint").alias("lab"), F.col(pred_col).cast("bigint").alias("pre"))
             .agg(F.count(F.lit(1)).alias("n")))
    if ignore_index is not None:
        pairs = pairs.filter(~F.col("lab").eqNullSafe(F.lit(ignore_index)))
    lab, pre, n, zero = F.col("lab"), F.col("pre"), F.col("n"), F.lit(0).cast("bigint")
    contrib = F.array(
        F.struct(lab.alias("cls"), n.alias("l"), zero.alias("p"), F.when(lab == pre, n).otherwise(zero).alias("tp")),
        F.struct(pre.alias("cls"), zero.alias("l"), n.alias("p"), zero.alias("tp")))
    per = (pairs.select(F.inline(contrib)).filter(F.col("cls").isNotNull())
           .groupBy("cls").agg(F.sum("l").alias("n_label"), F.sum("p").alias("n_pred"),
                               F.sum("tp").alias("tp")))
    if num_classes is not None:
        every = preds.sparkSession.range(num_classes).select(F.col("id").alias("cls"))
        per = every.join(per, "cls", "full").na.fill(0, ["n_label", "n_pred", "tp"])
    if ignore_index is not None:
        per = per.filter(F.col("cls") != ignore_index)
    inter = F.col("tp")
    union = F.col("n_label") + F.col("n_pred") - F.col("tp")
    return per.select(F.col("cls").alias("class_id"), inter.alias("intersection"), union.alias("union"),
                      ((inter.cast("double") + F.lit(smooth)) / (union.cast("double") + F.lit(smooth)))
                      .alias("iou"))


def iou_mean(preds: DataFrame, label_col: str = "label", pred_col: str = "prediction",
             smooth: float = SMOOTH, num_classes: int | None = None, ignore_index: int | None = None) -> DataFrame:
    """One row: number of classes and mean IoU over them."""
    per = iou_per_class(preds, label_col, pred_col, smooth, num_classes, ignore_index)
    return per.agg(F.count(F.lit(1)).alias("n_classes"), F.avg("iou").alias("iou_score"))


def jaccard_loss(preds: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                 smooth: float = SMOOTH, num_classes: int | None = None, ignore_index: int | None = None) -> DataFrame:
    """One row: jaccard_loss = 1 - mean IoU."""
    m = iou_mean(preds, label_col, pred_col, smooth, num_classes, ignore_index)
    return m.select("n_classes", (F.lit(1.0) - F.col("iou_score")).alias("jaccard_loss"))


def best_epoch(history: DataFrame, run_col: str = "run", epoch_col: str = "epoch",
               metric_col: str = "loss", mode: str = "min") -> DataFrame:
    """Per run: the epoch with the best monitored metric (ties -> earliest
    epoch), its value and the number of epochs. One aggregation; the
    min/max over a (metric, epoch) struct is deterministic under ties."""
    m = F.col(metric_col)
    key = F.struct((m if mode == "min" else -m).alias("v"), F.col(epoch_col).alias("e"))
    best = F.min(F.when(m.isNotNull(), key))
    return (history.groupBy(run_col)
            .agg(best.alias("_b"), F.count(F.lit(1)).alias("n_epochs"))
            .select(run_col, F.col("_b.e").alias("best_epoch"),
                    (F.col("_b.v") if mode == "min" else -F.col("_b.v")).alias("best_" + metric_col),
                    "n_epochs"))



def best_epoch_by_time(history: DataFrame, run_col: str = "run", time_col: str = "started",
                       key_col: str = "event_id", metric_col: str = "loss",
                       n_runs_bound: int | None = None, salts: int = 64) -> DataFrame:
    """Best epoch when epochs are numbered by start time (ties by key):
    the row with the smallest (metric, time, key) per run, numbered
    1 + (rows of the run that started before it).

    Two levels, salted: winners and counts per (run, salt), then per run over
    at most ``salts`` rows; the history meets the winners on (run, salt) and
    counts the rows before them there, then per run again. No exchange of the history
    is keyed by the run alone, so a run holding most of it is spread over ``salts``
    tasks even where the partial aggregates do not shrink it. ``n_runs_bound`` (if
    proven) lets the winners be broadcast, and the history is not moved at all."""
    m = F.col(metric_col)
    salt = F.pmod(F.xxhash64(time_col, key_col), F.lit(salts)).cast("int")
    salted = history.select(run_col, time_col, key_col, metric_col, salt.alias("_salt"))
    win = F.min(F.when(m.isNotNull(), F.struct(m.alias("v"), F.col(time_col).alias("t"), F.col(key_col).alias("k"))))
    best = (salted.groupBy(run_col, "_salt").agg(win.alias("_b"), F.count(F.lit(1)).alias("_n"))
            .groupBy(run_col).agg(F.min("_b").alias("_b"), F.sum("_n").alias("n_epochs")))
    rows = salted.select(run_col, time_col, key_col, "_salt")
    if n_runs_bound is not None:
        met = rows.join(F.broadcast(best), run_col, "inner")
    else:
        met = rows.join(best.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), [run_col, "_salt"], "inner")
    before = (F.col(time_col) < F.col("_b.t")) | ((F.col(time_col) == F.col("_b.t")) & (F.col(key_col) < F.col("_b.k")))
    per_salt = met.groupBy(run_col, "_salt").agg(
        F.sum(F.when(before, 1).otherwise(0)).alias("_before"), F.first("_b").alias("_b"), F.first("n_epochs").alias("n_epochs"))
    counted = per_salt.groupBy(run_col).agg(F.sum("_before").alias("_before"), F.min("_b").alias("_b"), F.min("n_epochs").alias("n_epochs"))
    return counted.select(run_col, F.when(F.col("_b").isNotNull(), (F.col("_before") + 1).cast("int")).alias("best_epoch"),
                          F.col("_b.v").alias("best_" + metric_col), "n_epochs")


def soft_confusion(preds: DataFrame, label_col: str = "label", prob_col: str = "probability",
                   ignore_index: int | None = None) -> DataFrame:
    """(label, n, p_sum): per label class the number of rows and the sum of
    their probability vectors (array<double>). One vector-sum aggregate of fixed
    size, partial and final: a row adds its vector to its label's buffer, nothing is
    exploded, and at most classes + 1 rows come out. Rows without probabilities are left out,
    as are rows labelled ``ignore_index``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    from pyspark.sql import types as T
    vec = F.col(prob_col)
    if isinstance(preds.schema[prob_col].dataType, T.ArrayType):
        vec = array_to_vector(vec.cast("array<double>"))
    rows = preds.filter(F.col(prob_col).isNotNull()).select(F.col(label_col).cast("bigint").alias("label"), vec.alias("_v"))
    if ignore_index is not None:
        rows = rows.filter(~F.col("label").eqNullSafe(F.lit(ignore_index)))
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), Summarizer.sum(F.col("_v")).alias("_s")) \
        .select("label", "n", vector_to_array("_s").alias("p_sum"))


def soft_iou_per_class(preds: DataFrame, label_col: str = "label", prob_col: str = "probability",
                       smooth: float = SMOOTH, ignore_index: int | None = None) -> DataFrame:
    """Soft IoU per class from class probabilities (array<double> or an ML
    vector): intersection = sum of p_c over rows labelled c, union =
    |label = c| + sum of p_c - intersection, iou = (I + s) / (U + s).
    Follow-up math over the at most classes + 1 rows of :func:`soft_confusion`.
    With ``ignore_index`` its rows are left out and it has no class of its own."""
    sums = soft_confusion(preds, label_col, prob_col, ignore_index).select("label", "n", F.posexplode("p_sum").alias("cls", "p"))
    hit = F.col("label") == F.col("cls")
    per = sums.groupBy(F.col("cls").cast("bigint").alias("class_id")).agg(
        F.sum(F.when(hit, F.col("p")).otherwise(0.0)).alias("intersection"),
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_label"),
        F.sum("p").alias("p_sum"))
    if ignore_index is not None:
        per = per.filter(F.col("class_id") != ignore_index)
    union = F.col("n_label") + F.col("p_sum") - F.col("intersection")
    return per.select("class_id", "intersection", union.alias("union"),
                      ((F.col("intersection") + F.lit(smooth)) / (union + F.lit(smooth))).alias("iou"))


def soft_jaccard_loss(preds: DataFrame, label_col: str = "label", prob_col: str = "probability",
                      smooth: float = SMOOTH, ignore_index: int | None = None) -> DataFrame:
    """One row: n_classes, soft iou_score (class mean) and jaccard_loss = 1 - score."""
    per = soft_iou_per_class(preds, label_col, prob_col, smooth, ignore_index)
    return per.agg(F.count(F.lit(1)).alias("n_classes"), F.avg("iou").alias("iou_score")) \
        .withColumn("jaccard_loss", F.lit(1.0) - F.col("iou_score"))
