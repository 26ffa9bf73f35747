"""Quality rules with distribution divergence, DataFrame functions only.

Base rules count what the contract names. The method then compares two
histograms of each document with references learned from all documents of its
language: characters by class (lower case, upper case, digits, white space,
symbols, others) and words by the language's commonest words (each of them,
and the rest). Distance is the Jensen-Shannon divergence in bits, 0 to 1. A
document far from its reference in either histogram fails, if it has at least
``MIN_WORDS`` words: shorter ones have too few for a histogram.

References are counts over the whole table: class totals, and words whose
share of a language is at least ``MIN_SHARE`` (so at most ``1 / MIN_SHARE`` a
language) of which the first ``COMMON_WORDS`` are used. They are a table with a
row per language, joined on it, and a row for all documents together: a NULL
language uses that, and so does one that the references do not hold. Scoring is
a narrow pass besides that join; long texts are worked on as arrays in one row,
in time proportional to their length (sorting aside).

Defined cases: NULL and empty texts have no words, fail the base rules and have
NULL divergences; repeated rows give a row each; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, cut, let, sliding

# The contract's symbols, window and limits.
SPACE = r"[\x20\x09\x0A\x0B\x0C\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
BASE_MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MIN_WORDS = 50
COMMON_WORDS = 16
MIN_SHARE = 0.002
MAX_CLASS_DIVERGENCE = 0.08
MAX_WORD_DIVERGENCE = 0.15


def _number(c: Column) -> Column:
    return c.cast("long")


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words in windows of ``window`` words that occur twice or more."""
    windows = lambda w: sliding(F.transform(w, lambda x: F.xxhash64(x)), window, F.xxhash64)

    def repeated(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s, k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return let(placed, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: same(s, k - 1, x) | same(s, k + 1, x)), lambda x: x["i"])))

    def covered(at: Column) -> Column:
        last = F.lit(window)
        return F.aggregate(F.transform(at, lambda p, k: F.least(last, F.coalesce(F.get(at, k + 1) - p, last))),
                           F.lit(0), lambda a, x: a + x)

    many = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(repeated(h), covered))
    return let(words, lambda w: F.coalesce(F.when(F.size(w) > window, let(windows(w), many)), F.lit(0)))


def _measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text"))
    t = F.col("text")
    return rows.select(
        "doc_id", "lang", "text", F.char_length(t).alias("n_chars"), F.regexp_count(t, F.lit(SPACE)).alias("spaces"),
        F.regexp_count(t, F.lit(SYMBOL)).alias("symbols"), F.regexp_count(t, F.lit(r"\p{Lu}")).alias("upper"),
        F.regexp_count(t, F.lit("[0-9]")).alias("digits"),
        (F.char_length(t) - F.char_length(F.regexp_replace(t, r"\p{Ll}+", ""))).alias("lower"))


CLASSES = ("lower", "upper", "digits", "spaces", "symbols")


def _classes() -> Column:
    other = F.col("n_chars") - sum(F.col(c) for c in CLASSES)
    return F.array(*[F.col(c).cast("double") for c in CLASSES], other.cast("double"))


def _reference(classes: Column, n_chars: Column, top: Column, n_words: Column) -> Column:
    """struct(classes, words, shares) of counts; what is left over comes last."""
    def rest(parts: Column) -> Column:
        return F.concat(parts, F.array(F.greatest(F.lit(0.0), 1 - F.aggregate(parts, F.lit(0.0), lambda s, x: s + x))))

    others = F.aggregate(top, F.lit(0).cast("long"), lambda s, x: s + x["n"])
    return F.struct(let(F.transform(classes, lambda x: x / n_chars), rest).alias("classes"), top["word"].alias("words"),
                    F.concat(F.transform(top, lambda x: x["n"] / n_words), F.array(F.greatest(F.lit(0.0), 1 - others / n_words))).alias("shares"))


def references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, ref): class shares, common words and their shares of every
    language; lang is NULL for all documents."""
    rows = _measured(docs, id_col, text_col, lang_col)
    names = (*CLASSES, "n_chars", "n_words")
    totals = cut(rows.withColumn("n_words", F.regexp_count("text", F.lit(WORD))).groupBy("lang").agg(
        *[F.sum(c).alias(c) for c in names]), "language-totals")
    words = rows.select("lang", F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word"))
    counts = cut(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "language-words")

    def top(c: DataFrame, by: list[str]) -> DataFrame:
        ranked = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "word", "n")))
        return c.filter(F.col("n") >= MIN_SHARE * F.col("n_words")).groupBy(*by).agg(F.slice(ranked, 1, COMMON_WORDS).alias("top"))

    known = totals.filter("lang is not null and n_words > 0 and n_chars > 0")
    own = top(counts.join(known.select("lang", "n_words"), "lang"), ["lang"])
    every = totals.agg(*[F.sum(c).alias(c) for c in names]).filter("n_words > 0 and n_chars > 0")
    every_top = top(counts.groupBy("word").agg(F.sum("n").alias("n")).crossJoin(F.broadcast(every.select("n_words"))), [])
    none = F.array().cast("array<struct<less:long,word:string,n:long>>")
    ref = _reference(F.array(*CLASSES), F.col("n_chars"), F.coalesce("top", none), F.col("n_words")).alias("ref")
    found = known.join(own, "lang", "left").select("lang", ref)
    return cut(found.unionByName(every.crossJoin(every_top).select(F.lit(None).cast("string").alias("lang"), ref)), "references")


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence in bits of two histograms that sum to 1."""
    half = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: let((a + b) / 2, lambda m: half(a, m) + half(b, m)))
    return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2


def rate(docs: DataFrame, found: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         lang_col: str = "lang") -> DataFrame:
    """One row per document: the base counts, class_divergence,
    word_divergence, base_failed, kept. ``found``: references, else learned
    from ``docs``."""
    found = references(docs, id_col, text_col, lang_col) if found is None else found
    every = found.filter("lang is null").select(F.col("ref").alias("every"))
    rows = _measured(docs, id_col, text_col, lang_col).join(found.filter("lang is not null"), "lang", "left")
    rows = rows.join(F.broadcast(every), F.lit(True), "left")
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))

    def word_shares(w: Column, ref: Column) -> Column:
        def shares(at: Column) -> Column:
            each = F.transform(F.sequence(F.lit(1), F.size(ref["words"])), lambda k: F.size(F.filter(at, lambda x: x == k)) / F.size(w))
            return F.concat(each, F.array(1 - F.size(at) / F.size(w)))

        places = F.filter(F.transform(w, lambda x: F.array_position(ref["words"], x)), lambda k: k > 0)
        return let(places, shares)

    def compared(w: Column) -> Column:
        enough = F.size(w) >= MIN_WORDS
        own = F.transform(_classes(), lambda x: x / F.col("n_chars"))
        return let(F.coalesce("ref", "every"), lambda r: F.struct(
            F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words"),
            F.when(enough & r.isNotNull(), divergence(own, r["classes"])).alias("class_divergence"),
            F.when(enough & (F.size(r["words"]) > 0), divergence(word_shares(w, r), r["shares"])).alias("word_divergence")))

    out = rows.select("doc_id", _number(F.col("n_chars") - F.col("spaces")).alias("word_chars"), _number(F.col("symbols")).alias("n_symbols"),
                      let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), let(words, compared).alias("m"))
    out = out.select("doc_id", "m.n_words", "word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words", "m.class_divergence", "m.word_divergence")
    failed = (F.col("n_words") < BASE_MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    near = ((F.coalesce("class_divergence", F.lit(0.0)) <= MAX_CLASS_DIVERGENCE)
            & (F.coalesce("word_divergence", F.lit(0.0)) <= MAX_WORD_DIVERGENCE))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & near)
