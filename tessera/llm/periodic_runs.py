"""Periodic runs of words: enhanced suffix array with the branching-tandem test.

A run is a stretch of words with smallest period q, at least ``min_length``
words and ``MIN_EXPONENT`` periods long, that cannot be extended on either side with
that period. Spark deals out the documents; a task works on chunks of whole
texts in numpy:

1. Words become numbers, different from document to document, so that one
   suffix array serves a whole chunk and no repeat crosses documents.
2. A run of length L and period q <= L/3 is covered by windows of
   ``min_length - min_length // 3`` words that occur again in the document
   (those of its first L-q words, and the same ones q words later). Only stretches
   covered by windows seen twice go on; a clash of window hashes can only
   keep a stretch more.
3. Suffix array by prefix doubling that sorts only what is still tied, LCP values by
   taking the doubling back step by step.
4. LCP intervals from one pass over the LCP values. For an interval of depth d the suffixes i
   of all children but the largest are looked at: i+d or i-d lies in the interval
   (its place is read from the inverse suffix array) exactly if a square of period d starts
   at i or i-d; it is branching if the next word differs. Those are O(n log n) places, and no tree is built.
5. Each run ends with exactly one branching square of its period. Rotating
   that square to the left as long as words agree gives the run's first word;
   squares of multiples of the period end in the same run and are merged into it.

Memory of a task is that of one chunk: ``CHUNK_BYTES`` of text, or one longer text.

Defined cases: NULL, empty and blank texts have no words and no runs and
collapse to the empty string. Repeated rows give repeated results; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 24
MIN_EXPONENT = 3
CHUNK_BYTES = 4_000_000
RUNS = "array<struct<start:long,length:long,period:long>>"
MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd constant that spreads bits


def repeated_stretches(words: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Which words lie in a window of ``width`` words that occurs twice in its document."""
    n = len(words)
    if n < width:
        return np.zeros(n, bool)
    code = (words.astype(np.uint64) + np.uint64(1)) * MIX
    code ^= code >> np.uint64(29)
    size, factor = 1, np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        while size < width:  # a window from two shorter ones that may overlap
            step = min(size, width - size)
            code = code[: len(code) - step] * factor + code[step:]
            code ^= code >> np.uint64(32)
            factor = factor * factor
            size += step
        code = (code + doc[: len(code)].astype(np.uint64)) * MIX
    at = np.flatnonzero(doc[: len(code)] == doc[width - 1 :])  # windows inside one document
    order = np.argsort(code[at], kind="stable")
    same = code[at][order][1:] == code[at][order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + width, -1)
    return np.cumsum(edge[:-1]) > 0


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse and LCP values of a text whose last symbol occurs once."""
    n = len(text)
    sa = np.argsort(text, kind="stable").astype(np.int64)
    first = np.empty(n, bool)
    first[0], first[1:] = True, text[sa[1:]] != text[sa[:-1]]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))
    undo, k = [], 1
    while len(tied):
        at = sa[tied]
        group, then = rank[at], rank[at + k]
        order = np.argsort(group * n + then, kind="stable")
        at, group, then = at[order], group[order], then[order]
        fresh = np.empty(len(at), bool)
        fresh[0], fresh[1:] = True, (group[1:] != group[:-1]) | (then[1:] != then[:-1])
        undo.append((k, at.astype(np.int32), group.astype(np.int32)))
        sa[tied] = at
        rank[at] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        tied = tied[~(fresh & np.append(fresh[1:], True))]
        k *= 2
    inverse = rank.copy()
    # Ranks by the first k symbols, for k from long to short: equal ranks are k equal symbols more.
    a, b = sa[:-1].copy(), sa[1:].copy()
    lcp = np.zeros(n, np.int64)
    while undo:
        k, at, old = undo.pop()
        rank[at] = old
        more = np.flatnonzero(rank[a] == rank[b])
        a[more] += k
        b[more] += k
        lcp[1:][more] += k
    return sa, inverse, lcp


def interval_bounds(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place p with lcp[p] > 0: p, and the first and last place of the
    LCP interval of that depth around it."""
    values = lcp.tolist()
    left, right = [0] * len(values), [len(values) - 1] * len(values)
    stack: list[int] = []
    for p, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = p - 1
        if v == 0:
            while stack:  # equal depths that end here
                right[stack.pop()] = p - 1
            left[p] = p
            stack.append(p)
            continue
        top = stack[-1]
        left[p] = left[top] if values[top] == v else top
        stack.append(p)
    inside = np.flatnonzero(lcp > 0)
    return inside, np.array(left, np.int64)[inside], np.array(right, np.int64)[inside]


def branching_squares(text: np.ndarray, sa: np.ndarray, inverse: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square that the next word does not continue."""
    n = len(text)
    at, lo, hi = interval_bounds(lcp)
    wide = hi - lo >= MIN_EXPONENT - 1  # a run of three periods has three suffixes in its interval
    at, lo, hi = at[wide], lo[wide], hi[wide]
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # Children of an interval: the stretches between the places of its own depth.
    key = lo * n + hi
    order = np.lexsort((at, key))
    at, lo, hi, key = at[order], lo[order], hi[order], key[order]
    opens = np.append(True, key[1:] != key[:-1])
    which = np.cumsum(opens) - 1
    heads, ends = lo[opens], hi[opens]
    depth = lcp[at[opens]]
    child_lo = np.concatenate([at, heads])
    child_of = np.concatenate([which, np.arange(len(heads))])
    order = np.lexsort((child_lo, child_of))
    child_lo, child_of = child_lo[order], child_of[order]
    last = np.append(child_of[1:] != child_of[:-1], True)
    child_hi = np.where(last, ends[child_of], np.append(child_lo[1:], 0) - 1)
    size = child_hi - child_lo + 1
    order = np.lexsort((-size, child_of))
    largest = order[np.append(True, child_of[order][1:] != child_of[order][:-1])]
    keep = np.ones(len(size), bool)
    keep[largest] = False
    child_lo, child_of, size = child_lo[keep], child_of[keep], size[keep]
    starts, periods = [], []
    # About a million suffixes at a time.
    for part in np.split(np.arange(len(size)), np.flatnonzero(np.diff(np.cumsum(size) // 1_000_000)) + 1):
        total = int(size[part].sum())
        if not total:
            continue
        place = np.arange(total) - np.repeat(np.cumsum(size[part]) - size[part], size[part]) + np.repeat(child_lo[part], size[part])
        of = np.repeat(child_of[part], size[part])
        i, d = sa[place], depth[of]
        for first in (i, i - d):
            other = np.where(first == i, i + d, first)  # the suffix whose place is looked up
            ok = (other >= 0) & (other < n)
            where = inverse[np.where(ok, other, 0)]
            ok &= (where >= heads[of]) & (where <= ends[of])
            f, p = first[ok], d[ok]
            branch = text[f + p] != text[f + 2 * p]
            starts.append(f[branch])
            periods.append(p[branch])
    return np.concatenate(starts), np.concatenate(periods)


def _back(text: np.ndarray, at: int, period: int) -> int:
    """How far words before ``at`` equal those a period later."""
    got, step = 0, 64
    while got < at:
        step = min(step, at - got)
        lo = at - got - step
        differ = np.flatnonzero(text[lo : lo + step] != text[lo + period : lo + step + period])
        if len(differ):
            return got + step - 1 - int(differ[-1])
        got, step = got + step, step * 2
    return got


def runs_of(text: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text whose last symbol occurs once."""
    starts, periods = branching_squares(text, *suffix_array(text))
    need = np.maximum(min_length, MIN_EXPONENT * periods) - 2 * periods
    for t in range(1, 17):  # rotations that all runs long enough allow
        on = (starts >= need) & ((need < t) | (text[np.maximum(starts - t, 0)] == text[np.maximum(starts - t, 0) + periods]))
        starts, periods, need = starts[on], periods[on], need[on]
    ends = starts + 2 * periods
    order = np.lexsort((periods, ends))
    found: list[tuple[int, int, int]] = []
    last_end = -1
    here: list[tuple[int, int, int]] = []
    for start, period, end in zip(starts[order].tolist(), periods[order].tolist(), ends[order].tolist()):
        if end != last_end:
            here, last_end = [], end
        if any(period % q == 0 and 2 * period <= length for _, length, q in here):
            continue  # a square of a power of a shorter period, or the same square once more
        first = start - _back(text, start, period)
        here.append((first, end - first, period))
        if end - first >= max(min_length, MIN_EXPONENT * period):
            found.append(here[-1])
    return found


def chunk_runs(words: np.ndarray, doc: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """(place, length, period) of all runs in a chunk of documents; ``doc`` is
    the number of the document of each word, in ascending order."""
    covered = repeated_stretches(words, doc, min_length - min_length // 3)
    at = np.flatnonzero(covered)
    if not len(at):
        return []
    _, symbol = np.unique(doc[at] * (int(words.max()) + 1) + words[at], return_inverse=True)
    breaks = np.append((np.diff(at) > 1) | (np.diff(doc[at]) > 0), True)
    # A separator of its own after each stretch; they sort after all words.
    shift = np.append(0, np.cumsum(breaks)[:-1])
    text = np.empty(len(at) + int(breaks.sum()), np.int64)
    source = np.full(len(text), -1, np.int64)
    place = np.arange(len(at)) + shift
    text[place], source[place] = symbol, at
    text[source < 0] = int(symbol.max()) + 1 + np.arange(int(breaks.sum()))
    return [(int(source[s]), length, q) for s, length, q in runs_of(text, min_length)]


def _finder(min_length: int, chunk_bytes: int):
    def chunk(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        split = [t.split() for t in texts]  # bytes are split at ASCII white space
        lens = np.array([len(w) for w in split], np.int64)
        base = np.cumsum(lens) - lens
        number = {w: i for i, w in enumerate(set().union(*split))} if split else {}
        flat = np.fromiter((number[w] for ws in split for w in ws), np.int64, int(lens.sum()))
        doc = np.repeat(np.arange(len(split)), lens)
        found: list[list[tuple[int, int, int]]] = [[] for _ in split]
        edge = np.zeros(len(flat) + 1, np.int32)
        for place, length, q in chunk_runs(flat, doc, min_length) if len(flat) else []:
            d = int(doc[place])
            found[d].append((place - int(base[d]), length, q))
            edge[place + q] += 1
            edge[place + length] -= 1
        stays = np.cumsum(edge[:-1]) == 0
        collapsed = []
        for d, ws in enumerate(split):
            found[d].sort(key=lambda r: (r[0], r[2]))
            collapsed.append(b" ".join(compress(ws, stays[base[d] : base[d] + lens[d]].tolist()) if found[d] else ws))
        flat_runs = [r for runs in found for r in runs]
        cols = np.array(flat_runs, np.int64).reshape(-1, 3).T
        runs = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(c) for c in cols], names=["start", "length", "period"]))
        return pa.record_batch([ids, pa.array(lens), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                               names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).cast(pa.binary())
            at = 0
            while at < batch.num_rows:
                texts, size, start = [], 0, at
                while at < batch.num_rows and (not texts or size < chunk_bytes):
                    texts.append(raw[at].as_py() or b"")
                    size += len(texts[-1])
                    at += 1
                yield chunk(batch.column(0).slice(start, at - start), texts)

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str | Column = "text",
                  chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period, by
    start and then period) and collapsed: the words without those that a run
    holds after its first period, joined by one space."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(text_col) if isinstance(text_col, str) else text_col).cast("string").alias("text"))
    return rows.mapInArrow(_finder(min_length, chunk_bytes), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def summary(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length in periods (ties: smallest
    start, then period), and digests of the runs and of the collapsed text."""
    runs = F.col("runs")
    best = F.aggregate(
        runs, F.get(runs, F.lit(0)),
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.try_divide(F.col("best.length") * 1000, F.col("best.period"))).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
