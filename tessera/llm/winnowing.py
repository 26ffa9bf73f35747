"""Benchmark decontamination by winnowing, with DataFrame functions only.

Texts are lower-cased (A-Z) word sequences. Every run of ``SPAN`` words that a
document shares with a benchmark item is found: of the hashes of the
``GRAM``-word grams inside each window of ``SPAN`` words the least is kept
(the leftmost of equals), in documents and items alike. A shared run of
``SPAN`` words has the same grams on both sides, so both keep the same one.
Kept grams are joined, and each hit is extended word by word to both sides as
long as the words agree, up to the reach of a window. Extended hits of at least
``SPAN`` words mark their words; shorter ones, and hash collisions, fall away.
Hits of a document are then merged as intervals.

Items of fewer than ``SPAN`` words are one window. Winnowing guarantees
nothing below its span, so these take a join on the whole window, one pass for
each such length that the benchmark has (at most ``SPAN - 1``).

Only kept grams (about a fifth of the words, as numbers) and the texts of
documents with hits are shuffled; no side is broadcast by hint.

Defined cases: NULL and empty texts have no words and no hits; items without
words or with a NULL id match nothing; repeated rows of documents give a row
each, repeated items count once; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, fresh, let, not_in, sliding

SPAN = 13
GRAM = 5
# A document is contaminated if at least 1 in this many of its words is hit.
WORDS_PER_HIT = 20
# The contract's words: no ASCII but digits and letters, lower case or any.
_GAPS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
WORD = not_in([*_GAPS, *range(0x41, 0x5B)])
WORD_ANY_CASE = not_in(_GAPS)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A kept gram as one number: its hash above, its position below this bit.
POS_BITS = 31


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def kept_grams(words: Column, span: int = SPAN, gram: int = GRAM) -> Column:
    """Distinct kept grams of an array of words, packed as hash and position."""
    hashes = lambda w: sliding(F.transform(w, lambda x: F.xxhash64(x)), gram, F.xxhash64)
    packed = lambda h: F.transform(h, lambda x, i: F.shiftleft(
        F.shiftrightunsigned(x, POS_BITS), POS_BITS).bitwiseOR(i.cast("long")))
    least = lambda w: F.array_distinct(sliding(packed(hashes(w)), span - gram + 1, F.least))
    return let(words, lambda w: F.when(F.size(w) >= span, least(w)))


def _unpacked(df: DataFrame, *keep: str) -> DataFrame:
    one = df.select(*keep, F.explode("grams").alias("g"))
    return one.select(*keep, F.shiftrightunsigned("g", POS_BITS).alias("gram"),
                      F.col("g").bitwiseAND(F.lit((1 << POS_BITS) - 1)).cast("int").alias("pos"))


def _run(same) -> Column:
    """How many of steps 1, 2, ... agree before the first that does not."""
    steps = F.sequence(F.lit(1), F.lit(SPAN - GRAM + 1))
    return F.array_min(F.filter(steps, lambda d: (d > SPAN - GRAM) | ~F.coalesce(same(d), F.lit(False)))) - 1


def _extended(met: DataFrame) -> DataFrame:
    """Matches with the document's words around them -> marked intervals."""
    w, v, p, q = F.col("around"), F.col("item_words"), F.col("at"), F.col("item_pos")
    agrees = lambda d: F.get(w, p + d) == F.get(v, q + d)
    left = _run(lambda d: F.when((p >= d) & (q >= d), agrees(-d)))
    right = _run(lambda d: agrees(d + (GRAM - 1)))
    same = F.forall(F.sequence(F.lit(0), F.lit(GRAM - 1)), lambda d: F.coalesce(agrees(d), F.lit(False)))
    sized = met.filter(same).select("k1", "k2", "item_id", "pos", left.alias("l"), right.alias("r"))
    return sized.filter(F.col("l") + F.col("r") + GRAM >= SPAN).select(
        "k1", "k2", "item_id", (F.col("pos") - F.col("l")).alias("lo"), (F.col("pos") + GRAM + F.col("r")).alias("hi"))


def _covered(spans: Column) -> Column:
    """Number of positions in the union of intervals (lo, hi)."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(x["lo"], a["end"]))).cast("long").alias("n"),
        F.greatest(a["end"], x["hi"]).alias("end"))
    return F.aggregate(F.sort_array(spans), zero, step, lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, k1, k2 (identify id and text), n_words,
    n_hit, items (sorted ids of items with occurring windows, as strings),
    contaminated."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(id_col, text).alias("k1"),
                       F.hash(text).alias("k2"), text.alias("text"))
    items = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
             .filter("item_id is not null").distinct()
             .select("item_id", F.xxhash64("item_id", "text").alias("item_key"), words_of(F.col("text")).alias("item_words")))
    items = cut(items.filter("size(item_words) > 0"), "items")

    long_items = items.filter(F.size("item_words") >= SPAN)
    wanted = cut(_unpacked(long_items.select("item_key", kept_grams(F.col("item_words")).alias("grams")), "item_key")
                 .withColumnRenamed("pos", "item_pos"), "item-grams")
    grams = _unpacked(rows.select("k1", "k2", kept_grams(words_of(F.col("text"))).alias("grams")), "k1", "k2")
    met = cut(grams.join(wanted, "gram").groupBy("k1", "k2").agg(
        F.collect_set(F.struct("pos", "item_key", "item_pos")).alias("met")), "matches")
    texts = rows.select("k1", "k2", "text").join(met, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    reach = SPAN - GRAM
    around = let(words_of(F.col("text")), lambda w: F.transform("met", lambda m: F.struct(
        m["pos"].alias("pos"), m["item_key"].alias("item_key"), m["item_pos"].alias("item_pos"),
        F.least(m["pos"], F.lit(reach)).alias("at"),
        F.slice(w, F.greatest(m["pos"] - reach, F.lit(0)) + 1, F.lit(2 * reach + GRAM)).alias("around"))))
    met = texts.select("k1", "k2", F.explode(around).alias("m")).select("k1", "k2", "m.*")
    hits = _extended(met.join(long_items, "item_key"))

    short = items.filter(F.size("item_words") < SPAN)
    lengths = sorted(r[0] for r in short.select(F.size("item_words")).distinct().collect())
    for n in lengths:
        windows = let(words_of(F.col("text")), lambda w: F.when(F.size(w) >= n, F.transform(  # noqa: B023
            F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))))  # noqa: B023
        runs = rows.select("k1", "k2", F.posexplode(windows).alias("lo", "words"))
        own = short.filter(F.size("item_words") == n).select("item_id", F.array_join("item_words", " ").alias("words"))
        hits = hits.unionByName(runs.join(own, "words").select("k1", "k2", "item_id", "lo", (F.col("lo") + n).alias("hi")))

    marks = hits.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"),
                                         F.sort_array(F.collect_set("item_id")).alias("items"))
    marks = marks.select("k1", "k2", _covered(F.col("spans")).alias("n_hit"), "items")
    sizes = rows.select("doc_id", "k1", "k2", F.coalesce(F.regexp_count("text", F.lit(WORD_ANY_CASE)), F.lit(0)).cast("long").alias("n_words"))
    out = sizes.join(marks, ["k1", "k2"], "left").withColumns({
        "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "items": F.coalesce("items", F.array().cast("array<string>"))})
    bad = (F.col("n_hit") > 0) & (WORDS_PER_HIT * F.col("n_hit") >= F.col("n_words"))
    return out.select("doc_id", "k1", "k2", "n_words", "n_hit", "items", bad.alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones; all columns stay as they are.
    With an empty benchmark, or one without words, every document stays."""
    a1, a2, b1, b2 = fresh(docs, "k1", "k2", "bad1", "bad2")
    bad = contamination(docs, benchmark, id_col, text_col).filter("contaminated").select(F.col("k1").alias(b1), F.col("k2").alias(b2)).distinct()
    text = F.col(text_col).cast("string")
    keyed = docs.withColumns({a1: F.xxhash64(id_col, text), a2: F.hash(text)})
    return keyed.join(bad, (F.col(a1) == F.col(b1)) & (F.col(a2) == F.col(b2)), "left_anti").drop(a1, a2)
