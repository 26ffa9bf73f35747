"""MinHash near-duplicate groups by tensored banding.

A document is the set of its distinct 5-word shingles. Documents whose sets
have a Jaccard similarity of at least 0.75 are linked, and a group is a
connected component of links.

*Tensored banding.* Instead of ``T`` independent tables of ``2r`` minhashes
each, ``m`` small collections of ``r`` minhashes are drawn and every pair
``i < j`` of them is a table: ``m (m - 1) / 2`` tables for ``m r`` minhash
evaluations, about a square root of what independent tables would need. A
pair of documents meets in some table when at least two collections agree;
with ``m = 24, r = 3`` a pair at similarity 0.75 does so with probability
0.99996, and a pair at 0.9 with probability above 1 - 1e-12.

*Plan.* Equal sets collapse to one class first, so thousands of exact copies
cost one row; classes are told apart by 128 bits of their set.

1. *Stars of collections.* Among the classes that have the value of one collection in common,
   every class is compared with one leader, so a group of near copies costs at most
   ``m`` comparisons for each member, whatever its size. The links found give components.
2. *Tensored tables.* A collection value that only one component has cannot link anything
   and is dropped before pairs are formed; of buckets (table, key) with the same
   members one is kept. Where a bucket's largest component has several members, those outside it are compared with a
   member of it, drawn for the bucket, and with one of another component, ``m`` in all for each class at most: what these miss
   step 3 finds.
3. *What stars leave open.* Buckets whose members still lie in several
   components are settled exactly, without rounds. A link between two
   components must share one of the rarest floor(n/4) + 1 shingles of each set (prefix filter
   at 0.75), in one order of shingles by their number among the open classes. Shingles
   that only one component has come first in it and are never a join key; nor
   is a passage that very many texts share, as it comes last. Where a shingle
   is shared, the places of the first common one bound the overlap, and pairs that cannot reach the
   threshold leave inside the join. Every pair of an open bucket that is linked is found this way.

Pairs whose odd sketches differ too much are ruled out without ever losing a link: the bits in which two differ are at most the shingles that only one
set has. Candidates are confirmed on the full shingle sets of whole texts. Bucket rows hold a key, a class
and its size; sketches are joined to candidate pairs only; tables that a later step has replaced are deleted.

*Defined cases.* NULL or blank texts have an empty set (size 0) and are linked
with nothing. Fewer than five words make one shingle of the whole sequence.
Rows with the same id and text are one node; rows with a NULL id take part in
groups but never name one unless the whole group lacks ids. Further columns
are ignored. Sets are compared through 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, fresh, remove

SHINGLE_WORDS = 5
COLLECTIONS = 24
COLLECTION_HASHES = 3
MIN_PERCENT = 75
SKETCH_BITS = 1024

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _WordIds(dict):
    """word -> 64-bit hash; emptied when large, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(text: str | None, ids: dict, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of ``text``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(ids.__getitem__, words), np.uint64, n)
    steps = min(n, k)
    h = np.full(n - steps + 1, steps, np.uint64)
    for j in range(steps):
        h = h * _MUL + w[j : n - steps + 1 + j]
        h ^= h >> np.uint64(32)
        h *= _MIX
    h ^= h >> np.uint64(29)
    return np.unique(h)


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of SKETCH_BITS cells, as 64-bit
    words. Every shingle that only one of two sets has flips one cell, so the
    bits in which two sketches differ never outnumber those shingles."""
    cells = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def _hash_family(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = rng.integers(0, 2**31, size=(2, count, 1), dtype=np.uint32)
    return draw[0] * np.uint32(2), draw[1] * np.uint32(2) + np.uint32(1)


def collection_values(hashes: np.ndarray, m: int, r: int, family) -> np.ndarray:
    """One 64-bit value for each of the m collections of r minhashes."""
    xor, mul = family
    short = (hashes >> np.uint64(17)).astype(np.uint32)
    low = np.full(m * r, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(low, ((short[None, at : at + 1024] ^ xor) * mul).min(axis=1), out=low)
    low = low.reshape(m, r).astype(np.uint64)
    out = np.arange(1, m + 1, dtype=np.uint64) * _MIX
    for j in range(r):
        out = (out ^ low[:, j]) * _MUL
        out ^= out >> np.uint64(32)
    return out


def _signatures(m: int, r: int, k: int):
    family = _hash_family(m * r)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _WordIds()
        for batch in batches:
            sizes, high, low, values, sketches = [], [], [], [], []
            for text in batch.column(2):
                h = shingle_hashes(text.as_py(), ids, k)
                sizes.append(len(h))
                both = np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), np.int64) if len(h) else (None, None)
                high.append(both[0])
                low.append(both[1])
                values.append(collection_values(h, m, r, family).view(np.int64) if len(h) else None)
                sketches.append(odd_sketch(h) if len(h) else None)
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(values, pa.list_(pa.int64())),
                pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "row_hash", "n_shingles", "high", "low", "vals", "sketch"])

    return run


def _confirm(percent: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _WordIds()
        last: tuple = (None, None)
        for batch in batches:
            left, right = batch.column(0), batch.column(1)
            keep = []
            for i in range(batch.num_rows):
                a = left[i].as_py()
                if a != last[0]:
                    last = (a, shingle_hashes(batch.column(2)[i].as_py(), ids, k))
                x, y = last[1], shingle_hashes(batch.column(3)[i].as_py(), ids, k)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([left.filter(mask), right.filter(mask)], names=["a", "b"])

    return run


def _shingles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _WordIds()
        for batch in batches:
            for i in range(batch.num_rows):
                h = shingle_hashes(batch.column(3)[i].as_py(), ids, k)
                same = [pa.array(np.full(len(h), batch.column(c)[i].as_py())) for c in range(3)]
                yield pa.record_batch([*same, pa.array(h.view(np.int64))], names=["cid", "n_shingles", "comp", "shingle"])

    return run


def _is_star_forest(e: DataFrame) -> bool:
    """Every u has one v and no v is a u: components are found."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).unionByName(
        e.select(F.col("v").alias("x"), F.lit(0).alias("ups"), F.lit(1).alias("downs")))
    ends = ends.groupBy("x").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return ends.filter("ups > 1 or ups > 0 and downs > 0").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for every node u of ``edges(a, b)``, v the least node of its
    connected component (nodes that are their own least node are left out).
    Alternates large-star and small-star steps, each a grouped minimum and a
    join, and writes every step to the shared folder."""
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .filter("u <> v").distinct(), "links")
    while not _is_star_forest(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links")
        remove(e)
        e = step
    return e


def _spanning(rows: DataFrame, key: str) -> DataFrame:
    """The rows (key, comp...) of keys that more than one component has."""
    live = rows.groupBy(key).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select(key)
    return rows.join(live, key, "left_semi")


def _bucket_rows(values: DataFrame) -> DataFrame:
    """(key, cid, n_shingles): a row for every table in which a class can meet
    another, from (h, cid, n_shingles): its collection values."""
    kept = values.groupBy("cid", "n_shingles").agg(F.sort_array(F.collect_list("h")).alias("hs")).filter("size(hs) > 1")
    pairs = F.explode(F.expr(
        "flatten(transform(sequence(1, size(hs) - 1), i -> transform(sequence(i + 1, size(hs)), "
        "j -> xxhash64(element_at(hs, i), element_at(hs, j)))))"))
    return kept.select("cid", "n_shingles", pairs.alias("key"))


def _distinct_buckets(rows: DataFrame) -> DataFrame:
    """The rows of one bucket for each set of members. Sets are told apart by
    their size and two 64-bit sums of their members."""
    sets = rows.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor("cid").alias("x"),
                                   F.bit_xor(F.xxhash64("cid")).alias("y"))
    return rows.join(sets.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    right = pairs.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("right")), "b")
    both = right.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("left")), "a")
    return both.select("a", "b", "left", "right").mapInArrow(_confirm(percent, k), "a long, b long")


def _linkable(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches leave a link possible."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    differ = sum(F.bit_count(F.col("s_a")[i].bitwiseXOR(F.col("s_b")[i])) for i in range(SKETCH_BITS // 64))
    return both.filter((100 + percent) * differ <= (100 - percent) * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _star_pairs(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """(a, b): the members of each bucket with the bucket's leader, where they
    are of different components and sizes allow a link. Rows: key, cid, n_shingles, comp."""
    lead = rows.groupBy(key).agg(F.min(F.struct("cid", "n_shingles", "comp")).alias("lead"))
    met = rows.join(lead, key).filter(F.col("comp") != F.col("lead.comp"))
    n, m = F.col("n_shingles"), F.col("lead.n_shingles")
    return met.filter(100 * F.least(n, m) >= percent * F.greatest(n, m)).select(F.least("cid", F.col("lead.cid")).alias("a"), F.greatest("cid", F.col("lead.cid")).alias("b")).distinct()


def _straggler_pairs(rows: DataFrame, percent: int, draws: int) -> DataFrame:
    """(a, b): the members of each bucket that are outside its largest
    component, if that is a group, with a member of it drawn for the bucket, and with one
    of another component; ``draws`` of these for each class. Rows: key, cid, n_shingles, comp."""
    drawn = F.min(F.struct(F.xxhash64("cid", "key").alias("draw"), "cid", "n_shingles")).alias("lead")
    per = rows.groupBy("key", "comp").agg(F.count("*").alias("n"), drawn)
    top = per.groupBy("key").agg(F.max(F.struct("n", "comp", "lead")).alias("top"), F.count("*").alias("comps")).filter("comps > 1 and top.n > 1")
    rest = per.join(top, "key").filter(F.col("comp") != F.col("top.comp"))
    other = rest.groupBy("key").agg(F.min(F.struct(F.col("lead.draw").alias("draw"), "comp", "lead")).alias("other"))
    met = rows.join(top.join(other, "key"), "key").filter(F.col("comp") != F.col("top.comp"))
    sides = F.explode(F.array(F.struct(F.col("top.comp").alias("comp"), F.col("top.lead").alias("lead")),
                              F.struct(F.col("other.comp").alias("comp"), F.col("other.lead").alias("lead")))).alias("with")
    met = met.select("cid", "n_shingles", "comp", sides).filter(F.col("comp") != F.col("with.comp"))
    n, m = F.col("n_shingles"), F.col("with.lead.n_shingles")
    near = met.filter(100 * F.least(n, m) >= percent * F.greatest(n, m))
    # A class is in at most m (m - 1) / 2 buckets, and so has twice as many to choose from at most.
    lead = F.col("with.lead.cid")
    near = near.groupBy("cid").agg(F.slice(F.sort_array(F.collect_set(F.struct(F.xxhash64("cid", lead).alias("draw"), lead.alias("lead")))), 1, draws).alias("drawn"))
    near = near.select("cid", F.explode("drawn.lead").alias("lead"))
    return near.select(F.least("cid", "lead").alias("a"), F.greatest("cid", "lead").alias("b")).distinct()


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` (cid...) with the component of each class found so far."""
    return rows.join(labels, F.col("cid") == F.col("u"), "left").withColumn("comp", F.coalesce("v", "cid")).drop("u", "v")


def _prefix_pairs(texts: DataFrame, percent: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(a, b): classes of different components that may be linked, and the table it reads.
    ``texts``: cid, n_shingles, comp, text of every class of an open bucket."""
    rows = texts.select("cid", "n_shingles", "comp", "text").mapInArrow(_shingles(k), "cid long, n_shingles long, comp long, shingle long")
    rows = cut(rows, "open-shingles")
    shared = (rows.groupBy("shingle").agg(F.count("*").alias("f"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
              .filter("lo <> hi").select("shingle", "f"))
    by_class = Window.partitionBy("cid")
    placed = rows.join(shared, "shingle").withColumn(
        "place", F.col("n_shingles") - F.count("*").over(by_class) + F.row_number().over(by_class.orderBy("f", "shingle")))
    # The rarest n - (shingles that a link needs) + 1 of each set, those of one component counted first.
    placed = placed.filter(100 * (F.col("place") - 1) <= (100 - percent) * F.col("n_shingles")).select("shingle", "cid", "n_shingles", "comp", "place")
    side = lambda x: placed.select(F.col("shingle"), *[F.col(c).alias(f"{c}_{x}") for c in ("cid", "n_shingles", "comp", "place")])
    n, m = F.col("n_shingles_a"), F.col("n_shingles_b")
    most = 1 + F.least(n - F.col("place_a"), m - F.col("place_b"))
    may = ((F.col("cid_a") < F.col("cid_b")) & (F.col("comp_a") != F.col("comp_b")) & (100 * F.least(n, m) >= percent * F.greatest(n, m))
           & ((100 + percent) * most >= percent * (n + m)))
    a, b = side("a").alias("l"), side("b").withColumnRenamed("shingle", "other")
    return a.join(b, (F.col("shingle") == F.col("other")) & may).select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b")).distinct(), rows


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = MIN_PERCENT, m: int = COLLECTIONS, r: int = COLLECTION_HASHES,
                    k: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: doc_id, row_hash (of the text), n_shingles, cid
    (class of equal sets, NULL if empty), component_id, kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row_hash"),
                       F.col(text_col).cast("string").alias("text"))
    marked = cut(rows.mapInArrow(_signatures(m, r, k),
                                 "doc_id long, row_hash long, n_shingles long, high long, low long, vals array<long>, sketch array<long>"),
                 "signatures")
    classes = marked.filter("n_shingles > 0").groupBy("high", "low").agg(
        F.min("n_shingles").alias("n_shingles"), F.min("vals").alias("vals"), F.min("sketch").alias("sketch"),
        F.min(F.struct("doc_id", "row_hash")).alias("rep"), F.min("doc_id").alias("least_id"))
    # Numbered once: the table that is written fixes the numbers.
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    def texts_of(wanted: DataFrame) -> DataFrame:
        ids = classes.select("cid", F.col("rep.doc_id").alias("rep_id"), F.col("rep.row_hash").alias("rep_hash")).join(wanted, "cid")
        found = rows.join(ids, rows.doc_id.eqNullSafe(ids.rep_id) & (rows.row_hash == ids.rep_hash))
        return cut(found.drop("doc_id", "row_hash", "rep_id", "rep_hash").dropDuplicates(["cid"]), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct())
        found = cut(_confirmed(pairs, texts, percent, k), "confirmed")
        remove(texts)
        return found

    def linked(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Components with the links among ``pairs``; stars found before stand for all earlier links."""
        if pairs.isEmpty():
            return components(pairs) if labels is None else labels
        found = confirmed(pairs)
        both = found if labels is None else found.unionByName(labels.select(F.col("u").alias("a"), F.col("v").alias("b")))
        new = components(both)
        for old in (found, labels):
            if old is not None:
                remove(old)
        return new

    def untried(pairs: DataFrame) -> DataFrame:
        once = cut(pairs, "pairs")  # each pair once, before it is joined to anything
        new = cut(_linkable(once.join(tried, ["a", "b"], "left_anti"), classes, percent), "candidates")
        remove(once)
        return new

    values = classes.select("cid", "n_shingles", F.col("cid").alias("comp"), F.posexplode("vals").alias("i", "val"))
    values = cut(_spanning(values.select(F.xxhash64("i", "val").alias("h"), "cid", "n_shingles", "comp"), "h"), "values")
    tried = cut(_linkable(_star_pairs(values, "h", percent), classes, percent), "candidates")
    labels = linked(tried, None)

    open_values = _spanning(_named(values.drop("comp"), labels), "h")
    tables = cut(_bucket_rows(open_values), "tables")
    buckets = cut(_spanning(_named(_distinct_buckets(tables), labels), "key"), "buckets")
    def open_buckets() -> DataFrame:
        return _spanning(_named(buckets.drop("comp"), labels), "key")

    pairs = untried(_straggler_pairs(open_buckets(), percent, m))
    labels = linked(pairs, labels)
    tried = tried.unionByName(pairs)

    open_classes = open_buckets().select("cid", "n_shingles", "comp").distinct()
    texts = texts_of(open_classes)
    pairs, read = _prefix_pairs(texts, percent, k)
    pairs = untried(pairs)
    for done in (read, texts, tables, buckets, values):
        remove(done)
    labels = linked(pairs, labels)

    named = _named(classes.select("cid", "high", "low", "least_id"), labels)
    comps = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    named = named.join(comps, "comp").select("cid", "high", "low", "component_id")
    out = marked.drop("vals", "sketch").join(named, ["high", "low"], "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "row_hash", "n_shingles", "cid", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id.
    Repeated rows (same id, same text) count as copies; of those that differ
    in other columns the one with the smallest hash of the whole row stays."""
    own_id, own_hash, key, row = fresh(docs, "own_id", "own_hash", "text_key", "row")
    marks = near_duplicates(docs, id_col, text_col, **kw).filter("kept").select(
        F.col("doc_id").alias(own_id), F.col("row_hash").alias(own_hash)).distinct()
    keyed = docs.withColumn(key, F.xxhash64(F.col(text_col)))
    keyed = keyed.join(marks, F.col(id_col).cast("long").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_hash)), "left_semi")
    whole = F.struct(*docs.columns)
    one = keyed.groupBy(F.col(id_col), F.col(key)).agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias(row))
    return one.select(*[F.col(row)[c].alias(c) for c in docs.columns])
