"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over
hashed character n-grams (orders 1 to 3, lower case, other characters as
blanks) tells the languages whose bit is 1 from the others: its weights are log
ratios of the mean n-gram frequencies of the two sides. The n-gram counts come
from all training rows in one distributed sum, and so do the frequencies of the
sides; the driver gets a total per language and the table of buckets x bits.
Frequencies are summed as integers, so the order of the sum does not matter.

A text's margin for a bit is its mean weight times the square root of its
n-grams. Decoding adds, per language, the logistic losses of all bits against
its codeword, weighted by how well the bit's classifier separates its sides,
and picks the least loss. The score is the softmax of the negative losses. A
text whose two best losses are closer than ``AMBIGUOUS`` is flagged.

Up to ``EXHAUSTIVE`` languages use the exhaustive code (all splits), more a
dense code of ``DENSE_BITS`` bits or ``BITS_PER_DOUBLING`` for each doubling of
their number, the best of ``DRAWS`` seeded draws by least Hamming distance (one
draw where comparing all pairs would cost more than the draws of 64 languages).
Every language with an n-gram is learned.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0; a
NULL id is not held out; rows with a NULL lang are predicted but teach nothing;
with no training rows everything is ``und``; repeated rows give a row each.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, doc_hash, fresh

BUCKETS = 1 << 14
EXHAUSTIVE = 5
DENSE_BITS, BITS_PER_DOUBLING, DRAWS = 31, 5, 200
PAIRS = DRAWS * 64 * 64
TABLES, CELLS = 64, 1 << 21
SMOOTHING = 0.5
AMBIGUOUS = 0.05
CHUNK_CHARS = 400_000
UNDETERMINED = "und"
FOLDS, HELD_OUT = 4, 2


_HELD: dict[str, np.ndarray] = {}  # a plain dict: functions of this module go to workers by value


def _letters() -> np.ndarray:
    if "letters" not in _HELD:
        _HELD["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _HELD["letters"]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every n-gram, text it is from, letters of each text)."""
    # Blanks around each text: no n-gram reaches into a neighbour, whatever texts share a chunk.
    lows = [f" {t.lower()}  " for t in texts]
    lens = np.fromiter(map(len, lows), np.int64, len(lows))
    cp = np.frombuffer("".join(lows).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cp]
    owner = np.repeat(np.arange(len(lows), dtype=np.int32), lens)
    c = np.where(letter, cp, np.uint32(32))
    one = c * np.uint32(0x9E3779B1)
    two = np.zeros_like(one)
    two[:-1] = (one[:-1] ^ (one[:-1] >> np.uint32(15))) + c[1:] * np.uint32(0x85EBCA6B)
    three = np.zeros_like(one)
    three[:-2] = (two[:-2] ^ (two[:-2] >> np.uint32(13))) * np.uint32(0xC2B2AE35) + c[2:] * np.uint32(0x27D4EB2F)
    # An n-gram starts at a letter, or at a blank before a letter.
    start = letter.copy()
    start[:-1] |= letter[1:]
    at = np.flatnonzero(start)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    parts = [(h[at] * np.uint32(0x2C1B3C6D) + np.uint32(n)) * np.uint32(0x297A2D39) >> shift for n, h in enumerate((one, two, three))]
    return np.concatenate(parts), np.tile(owner[at], 3), np.bincount(owner[letter], minlength=len(lows))


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    at = 0
    while at < len(texts):
        start, size = at, 0
        while at < len(texts) and (at == start or size < CHUNK_CHARS):
            size += len(texts[at])
            at += 1
        yield start, texts[start:at]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for start, part in _chunks(texts):
            bucket, owner, _ = grams(part)
            names = langs[start : start + len(part)]
            distinct = sorted(set(names))
            place = {name: k for k, name in enumerate(distinct)}
            code = np.array([place[x] for x in names])
            at = code[owner] * BUCKETS + bucket
            if len(distinct) > TABLES:
                # Too many for dense tables: the counts go out as they are.
                cell, n = np.unique(at, return_counts=True)
                yield pa.record_batch([pa.array(distinct).take(pa.array(cell // BUCKETS)), pa.array((cell % BUCKETS).astype(np.int32)),
                                       pa.array(n.astype(np.int64))], names=["lang", "bucket", "n"])
                continue
            n = np.bincount(at, minlength=len(distinct) * BUCKETS).reshape(-1, BUCKETS)
            for name, row in zip(distinct, n):
                tables[name] = tables[name] + row if name in tables else row
            if len(tables) > TABLES:
                yield from _rows(tables)
                tables = {}
    yield from _rows(tables)


def _rows(tables: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, row in tables.items():
        at = np.flatnonzero(row)
        yield pa.record_batch([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(row[at].astype(np.int64))],
                              names=["lang", "bucket", "n"])


def codewords(n: int) -> np.ndarray:
    """(languages, bits) matrix of -1 and 1."""
    if n <= EXHAUSTIVE:
        splits = [s for s in itertools.product((-1, 1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, float).T.reshape(n, -1)
    rng = np.random.default_rng(5)
    bits = max(DENSE_BITS, math.ceil(BITS_PER_DOUBLING * math.log2(n)))
    best, least = None, -1
    for _ in range(max(1, min(DRAWS, PAIRS // n**2))):
        code = rng.choice([-1.0, 1.0], size=(n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        if PAIRS // n**2 <= 1:
            return code
        differ = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * bits
        if differ.min() > least:
            best, least = code, differ.min()
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of each text."""
        names, scores, flags = [], [], []
        for _, part in _chunks([t or "" for t in texts]):
            bucket, owner, letters = grams(part)
            n = np.bincount(owner, minlength=len(part))
            margins = np.stack([np.bincount(owner, self.weights[bucket, b], len(part)) for b in range(self.weights.shape[1])], axis=1) \
                if self.weights.shape[1] else np.zeros((len(part), 0))
            margins = margins / np.sqrt(np.maximum(n, 1))[:, None]
            step = max(1, CELLS // max(1, len(self.langs)))
            for lo in range(0, len(part), step):
                some = margins[lo : lo + step]
                loss = np.stack([np.logaddexp(0, -some * row) @ self.trust for row in self.code], axis=1) \
                    if self.langs else np.zeros((len(some), 1))
                ranked = np.partition(loss, 1, axis=1)[:, :2] if loss.shape[1] > 1 else loss
                known = (letters[lo : lo + step] > 0) & bool(self.langs)
                share = np.exp(ranked[:, :1] - loss).sum(axis=1)
                names += [self.langs[k] if ok else UNDETERMINED for k, ok in zip(loss.argmin(axis=1), known)]
                scores.append(np.where(known, 1 / share, 0.0))
                gap = ranked[:, 1] - ranked[:, 0] if ranked.shape[1] > 1 else np.full(len(some), np.inf)
                flags.append(known & (gap < AMBIGUOUS))
        return names, np.concatenate(scores) if scores else np.zeros(0), np.concatenate(flags) if flags else np.zeros(0, bool)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(doc_hash(id_col), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows that are not held out and have text and lang."""
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = cut(counts, "language-counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    code = codewords(len(langs)) if langs else np.zeros((0, 0))
    weights, trust = np.zeros((BUCKETS, code.shape[1])), np.zeros(code.shape[1])
    if not code.size:
        return Model(langs, code, weights, trust)
    sizes = np.array([totals[x] for x in langs]) + SMOOTHING * BUCKETS
    # Shares as integers: the sum over all languages stays below 2 ** 62.
    unit = 2.0 ** (61 - math.ceil(math.log2(len(langs))))
    table = [(x, float(n), [bool(c > 0) for c in row]) for x, n, row in zip(langs, sizes, code)]
    sides = counts.join(F.broadcast(docs.sparkSession.createDataFrame(table, "lang string, size double, bits array<boolean>")), "lang")
    share = F.floor(F.col("n") / F.col("size") * unit).cast("long")
    per_bit = [F.sum(F.when(F.get("bits", F.lit(b)), share).otherwise(0)).alias(f"b{b}") for b in range(code.shape[1])]
    held = np.zeros((BUCKETS, code.shape[1] + 1), np.int64)
    for r in sides.groupBy("bucket").agg(F.sum(share).alias("every"), *per_bit).collect():
        held[r["bucket"]] = r[1:]
    for b in range(code.shape[1]):
        up = code[:, b] > 0
        one = (held[:, b + 1] / unit + (SMOOTHING / sizes[up]).sum()) / up.sum()
        zero = ((held[:, 0] - held[:, b + 1]) / unit + (SMOOTHING / sizes[~up]).sum()) / (~up).sum()
        weights[:, b] = np.log(one / zero)
        trust[b] = ((one - zero) * weights[:, b]).sum()
    return Model(langs, code, weights, trust / max(trust.mean(), 1e-9))


def predictions(text: Column, model: Model) -> Column:
    """struct(lang_pred, score, ambiguous) of a text column."""
    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores, flags = model.predict(texts.where(texts.notna(), None).tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores, "ambiguous": flags})

    return predict(text)


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, ambiguous."""
    model = fit(docs, id_col, text_col, lang_col) if model is None else model
    found = predictions(F.col(text_col).cast("string"), model)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), found.alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score", "p.ambiguous")


def drop_undetermined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without texts that have no language or an ambiguous one (and
    so without NULL and empty texts); all columns stay as they are."""
    found = predictions(F.col(text_col).cast("string"), fit(docs, id_col, text_col, lang_col))
    [mark] = fresh(docs, "found")
    marked = docs.withColumn(mark, found)
    return marked.filter((F.col(mark)["lang_pred"] != UNDETERMINED) & ~F.col(mark)["ambiguous"]).drop(mark)
