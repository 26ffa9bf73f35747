"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear function of text features; the chance that
one document is preferred to another is the logistic function of the
difference of their strengths. Preference pairs set a training document of
quality 1 against one of quality 0, every one against every other; the weights
minimise the mean logistic loss of the feature differences plus a small ridge
(Newton steps). Documents are then accepted by a quantile of the training
strengths, the share of quality 0: the score is a logistic scale on which that
quantile is ``ACCEPT``.

Training uses all labelled rows and all pairs. Their features are written once
as a narrow table; each Newton step is one pass over it. The loss of a pair
depends on its two strengths by a smooth function alone, so a row is spread
over ``NODES`` Chebyshev nodes of the unit interval that its strength is in,
with interpolation weights, and tasks add up these weights times 1, features
and products of features. Sums over all pairs of rows are then sums over pairs
of nodes, alike to about 1e-10 of their size. The driver holds sums per node, never rows.
The quantile is exact: each pass counts bins and keeps the one with the rank
asked for. Features and scores of all documents are computed in tasks, without
shuffling a text.

Defined cases: NULL and empty texts have zero features and get a score like any
other; labels that are NULL, repeated for an id with different values, or held
out teach nothing; with one class only every score is 0.5; repeated rows
give a row each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import cut, doc_hash, remove

MAX_PAIRS = 100_000  # of fit_pairs alone
RIDGE = 1e-3
STEPS = 25
MAX_PASSES = 200
SMALL_STEP = 1e-6  # what then remains is about its square
NODES = 10
BLOCK = 1_000_000
BINS = 1000
ACCEPT = 0.3
FOLDS, HELD_OUT = 5, 0
SYMBOLS = "#*$%&|<>!"
NAMES = ("words", "word_length", "symbols", "upper", "digits", "punctuation", "repeats", "bigrams", "vocabulary", "lines", "top_word", "all_upper")


def _classes() -> np.ndarray:
    """Class of each byte of Latin-1: 1 upper, 2 digit, 3 symbol, 4 other punctuation, 0 rest."""
    kind = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        kind[b] = 1 if c.isupper() else 2 if c.isdigit() else 3 if c in SYMBOLS else 4 if b < 128 and not c.isalnum() and not c.isspace() else 0
    return kind


_KIND = _classes()


def features(text: str | None) -> np.ndarray:
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.zeros(len(NAMES))
    by_byte = np.bincount(np.frombuffer(text.encode("latin-1", "replace"), np.uint8), minlength=256)
    kinds = np.bincount(_KIND, by_byte, 5)
    chars = len(text)
    distinct = set(words)
    lines = [x for x in text.split("\n") if x.strip()]
    counted = sum(map(len, words))
    follow = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    shouted = sum(map(str.isupper, words))
    share = lambda x, of: np.log((x + 0.05) / (of + 0.05) + 0.01)
    return np.array([np.log1p(n), counted / n / 10, share(kinds[3], chars), share(kinds[1], chars), share(kinds[2], chars),
                     share(kinds[4], chars), share(follow, n), share(pairs, max(n - 1, 1)), share(len(distinct), n),
                     share(len(lines) - len(set(lines)), len(lines)), share(n - len(distinct), n), share(shouted, n)])


@dataclass
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    cut: float
    steepness: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = ((x - self.mean) / self.scale) @ self.weights
        z = self.steepness * (s - self.cut) + (np.log(ACCEPT / (1 - ACCEPT)) if self.weights.any() else 0.0)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_pairs(x: np.ndarray, quality: np.ndarray, seed: int = 3) -> Model:
    """Bradley-Terry weights of rows ``x`` at hand, from at most ``MAX_PAIRS`` drawn
    pairs of quality 1 against 0. :func:`fit` is the fit to all pairs."""
    mean, scale = (x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)) if len(x) else (np.zeros(len(NAMES)), np.ones(len(NAMES)))
    z = (x - mean) / scale
    good, bad = z[quality == 1], z[quality == 0]
    weights = np.zeros(len(mean))
    if not len(good) or not len(bad):
        return Model(weights, mean, scale, 0.0, 1.0)
    rng = np.random.default_rng(seed)
    n = min(MAX_PAIRS, len(good) * len(bad))
    d = good[rng.integers(len(good), size=n)] - bad[rng.integers(len(bad), size=n)]
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(d @ weights, -40, 40)))
        gradient = d.T @ (p - 1) / n + RIDGE * weights
        curvature = (d * (p * (1 - p))[:, None]).T @ d / n + RIDGE * np.eye(len(weights))
        step = np.linalg.solve(curvature, gradient)
        weights -= step / max(1.0, np.abs(step).max())
    s = z @ weights
    return Model(weights, mean, scale, float(np.quantile(s, len(bad) / len(z))), 1.0)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(doc_hash(id_col), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def text_features(texts: pd.Series) -> pd.Series:
    return texts.map(features)


def spread(strengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit interval of each strength, and weights of its nodes: for a smooth
    f the weighted sum of f over the nodes is f(strength)."""
    interval = np.floor(strengths)
    basis = np.polynomial.chebyshev.chebvander(2 * (strengths - interval) - 1, NODES - 1)
    at_nodes = np.polynomial.chebyshev.chebvander(np.polynomial.chebyshev.chebpts1(NODES), NODES - 1)
    at_nodes[:, 0] /= 2
    return interval.astype(np.int64), basis @ at_nodes.T * (2 / NODES)


def _node_sums(mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
    """Per quality, interval and node: sums of node weights times 1, z and the upper half of zz'."""
    above = np.triu_indices(len(mean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            z = (batch.column(1).flatten().to_numpy().reshape(-1, len(mean)) - mean) / scale
            quality = batch.column(0).to_numpy()
            interval, shares = spread(z @ weights)
            values = np.hstack([np.ones((len(z), 1)), z, z[:, above[0]] * z[:, above[1]]])
            for q, i in {*zip(quality.tolist(), interval.tolist())}:
                rows = (quality == q) & (interval == i)
                sums[q, i] = sums.get((q, i), 0) + shares[rows].T @ values[rows]
        keys = [(q, i, k) for q, i in sums for k in range(NODES)]
        for part in range(0, len(keys), BLOCK // 100):
            some = keys[part : part + BLOCK // 100]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0] for key in some], pa.int32()), pa.array([key[1] for key in some], pa.int64()), pa.array([key[2] for key in some], pa.int32()),
                 pa.array([sums[q, i][k] for q, i, k in some], pa.list_(pa.float64()))], names=["quality", "interval", "node", "v"])

    return run


def _newton_step(good: tuple[np.ndarray, np.ndarray], bad: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Newton step of the mean loss over all pairs, from places and sums of the nodes of either quality."""
    d = len(weights)
    above = np.triu_indices(d)

    def matrix(upper: np.ndarray) -> np.ndarray:
        m = np.zeros((d, d))
        m[above] = upper
        return m + np.triu(m, 1).T

    (at_good, of_good), (at_bad, of_bad) = good, bad
    pairs = of_good[:, 0].sum() * of_bad[:, 0].sum()
    gradient, curvature = RIDGE * weights, RIDGE * np.eye(d)
    size = max(1, BLOCK // len(at_bad))
    for part in range(0, len(at_good), size):
        g = of_good[part : part + size]
        p = 1 / (1 + np.exp(-np.clip(at_good[part : part + size, None] - at_bad, -40, 40)))
        slope, bend = p - 1, p * (1 - p)
        gradient += (g[:, 1 : d + 1].T @ (slope @ of_bad[:, 0]) - of_bad[:, 1 : d + 1].T @ (slope.T @ g[:, 0])) / pairs
        cross = g[:, 1 : d + 1].T @ bend @ of_bad[:, 1 : d + 1]
        curvature += (matrix(g[:, d + 1 :].T @ (bend @ of_bad[:, 0])) + matrix(of_bad[:, d + 1 :].T @ (bend.T @ g[:, 0])) - cross - cross.T) / pairs
    return np.linalg.solve(curvature, gradient)


def order_statistic(values: DataFrame, rank: int) -> float:
    """The value of this rank, from 0, in the column ``s``, which has no NULL."""
    lo, hi = values.agg(F.min("s"), F.max("s")).first()
    while lo < hi:
        place = F.least(F.floor((F.col("s") - lo) / (hi - lo) * BINS), F.lit(BINS - 1))
        counted = values.filter(F.col("s").between(lo, hi)).groupBy(place.alias("place")).agg(F.count("s").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"))
        for r in sorted(counted.collect()):
            if rank < r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            rank -= r["n"]
    return lo


def quantile(values: DataFrame, n: int, share: float) -> float:
    """Quantile of the ``n`` values in ``s``, between ranks by straight line."""
    rank, part = divmod(share * (n - 1), 1)
    low = order_statistic(values, int(rank))
    upto, high = values.agg(F.count_if(F.col("s") <= low), F.min(F.when(F.col("s") > low, F.col("s")))).first()
    return low + part * (high - low) if part and upto < rank + 2 else low


def fit_table(rows: DataFrame) -> Model:
    """Model of all rows of a table (quality 0 or 1, x), all pairs counted."""
    d = len(NAMES)
    got = rows.agg(F.count("x"), F.sum("quality"), *[f(F.col("x")[k]) for f in (F.avg, F.stddev_pop) for k in range(d)]).first()
    n, n_good = got[0], got[1] or 0
    # Rounded, so that the order in which tasks add does not show.
    mean, scale = (np.round(got[2 : d + 2], 9), np.maximum(np.round(got[d + 2 :], 9), 1e-6)) if n else (np.zeros(d), np.ones(d))
    weights = np.zeros(d)
    if not 0 < n_good < n:
        return Model(weights, mean, scale, 0.0, 1.0)
    nodes = (np.polynomial.chebyshev.chebpts1(NODES) + 1) / 2
    for done in range(MAX_PASSES):
        parts = rows.select("quality", "x").mapInArrow(_node_sums(mean, scale, weights), "quality int, interval long, node int, v array<double>")
        sums = parts.groupBy("quality", "interval", "node").agg(*[F.sum(F.col("v")[k]) for k in range(1 + d + d * (d + 1) // 2)]).toPandas().to_numpy(float)
        good, bad = ((of[:, 1] + nodes[of[:, 2].astype(int)], of[:, 3:]) for of in (sums[sums[:, 0] == 1], sums[sums[:, 0] == 0]))
        step = _newton_step(good, bad, weights)
        weights = weights - step / max(1.0, np.abs(step).max() * max(1.0, done / STEPS))
        if np.abs(step).max() < SMALL_STEP:
            break
    else:
        raise RuntimeError(f"the weights still move after {MAX_PASSES} Newton steps")
    weights = np.round(weights, 8)
    s = rows.select(reduce(add, [(F.col("x")[k] - float(mean[k])) / float(scale[k]) * float(weights[k]) for k in range(d)]).alias("s"))
    return Model(weights, mean, scale, quantile(s, n, (n - n_good) / n), 1.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
             .filter(F.col("quality").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id"))
             .groupBy("id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most").select("id", "quality"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter(F.col("id").isNotNull() & ~held_out("id"))
    # Features before the join: it then moves 12 numbers a row, never a text.
    table = cut(rows.select("id", text_features(F.coalesce("text", F.lit(""))).alias("x")).join(known, "id").select("quality", "x"), "quality_features")
    try:
        return fit_table(table)
    finally:
        remove(table)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack([features(t) for t in texts])) if len(texts) else np.zeros(0))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), scored(text).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
