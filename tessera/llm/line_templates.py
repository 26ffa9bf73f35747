"""Line dedup by a log-template tree, DataFrame functions only.

Lines are parsed as log messages are. A token with a digit is a variable field
and becomes ``<*>``. The tree has fixed depth: the root branches on the number
of tokens, the next ``DEPTH`` levels on the leading tokens. A template recurs if
it occurs in at least ``MIN_TEXTS`` different texts (copies of one text count
once); in step 1 ``LONG_TEXTS`` are enough for one of over ``LONG_TOKENS``
tokens. Templates come from two steps:

1. the masked line itself, if more than half of its tokens are constant; else
   the whole line, so rows of numbers recur only as they stand;
2. in a leaf whose remaining lines come from ``MIN_TEXTS`` texts or more, each
   token is counted at its position. A line has a template for each count c
   among its tokens: tokens counted less than c become ``<*>``, and at least
   ``MIN_CONSTANT`` of 10 positions must keep one. So a leaf holds any number of
   templates, and lines that share few tokens with them do not hide them. The
   lines of recurring templates leave and the step is repeated on the others of
   their leaves until none is found.

A recurring template is dropped from every document but the one with the
smallest id. Its constant tokens stay there; the field values of the dropped
lines are lost from the whole. Lines of fewer than
``MIN_TOKENS`` tokens are left alone.

Counting works on hashes: (template, text) pairs first, then templates, so a
line in a third of all documents is spread over tasks. The only shuffle of
texts is the last join; tokens are re-read for leaves of step 2 alone.

Defined cases: a NULL text stays NULL with 0 lines; an empty text has one empty
line; repeated rows are one text and drop the same lines; among NULL ids a
template that has no other id stays; extra columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, fresh, let

MIN_TEXTS = 5
LONG_TOKENS, LONG_TEXTS = 50, 2
MIN_TOKENS = 2
DEPTH = 4
MIN_CONSTANT = 7
LINE = ("doc_id", "key", "text_hash", "line_no", "n", "leaf")
SPACES = r"[\x20\x09\x0A\x0B\x0C\x0D]+"
UNEVEN = r"[\x09\x0A\x0B\x0C\x0D]|\x20\x20|^\x20|\x20$"
MASKED = r"(?<![^\x20])<\*>(?![^\x20])"
FIELD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def _key(id_col: str, text_col: str) -> Column:
    """128 bits of a document's id and text: they decide whose lines are dropped."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.col(text_col).cast("string")).cast("binary")))


def _parsed(line: Column) -> Column:
    """struct(line, n, tpl, leaf): the masked line with single blanks, its
    tokens, and hashes of it and of its place in the tree, NULL with too few
    tokens."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, "<*>")).otherwise(line)
    single = lambda x: F.when(x.rlike(UNEVEN), F.btrim(F.regexp_replace(x, SPACES, " "))).otherwise(x)

    def hashed(x: Column) -> Column:
        n = F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit(""))) + 1
        enough = n >= MIN_TOKENS
        fields = F.when(x.contains("<*>"), F.regexp_count(x, F.lit(MASKED))).otherwise(0)
        whole = F.when(2 * fields < n, F.xxhash64(x)).otherwise(F.xxhash64(single(line)))
        return F.struct(x.alias("line"), n.alias("n"), F.when(enough, whole).alias("tpl"),
                        F.when(enough, F.xxhash64(n, F.substring_index(x, " ", DEPTH))).alias("leaf"))

    return let(let(masked, single), hashed)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per line: doc_id, key, text_hash, line_no, p (struct of ``_parsed``)."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(id_col, text_col).alias("key"),
                       F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return rows.select("doc_id", "key", "text_hash", "line_no", _parsed(F.col("line")).alias("p"))


def _recurring(lines: DataFrame, by: str, long_texts: int = MIN_TEXTS) -> DataFrame:
    """``by`` values found in enough texts, with the smallest id. Lines of over
    ``LONG_TOKENS`` tokens need ``long_texts``."""
    pairs = lines.groupBy(by, "text_hash").agg(F.min("doc_id").alias("first_id"), F.max("n").alias("n"))
    enough = F.when(F.col("n") > LONG_TOKENS, long_texts).otherwise(MIN_TEXTS)
    return (pairs.groupBy(by).agg(F.count("*").alias("texts"), F.min("first_id").alias("first_id"), F.max("n").alias("n"))
            .filter(F.col("texts") >= enough).select(by, "first_id"))


def _to_drop(lines: DataFrame, recurring: DataFrame, by: str) -> DataFrame:
    return (lines.join(recurring, by).filter(~F.col("doc_id").eqNullSafe(F.col("first_id"))).select("key", "line_no"))


def _general(lines: DataFrame) -> DataFrame:
    """The lines of the general templates of ``lines``: key, line_no, leaf, gone
    (the template is in a document of smaller id)."""
    tokens = lines.select(*LINE, F.posexplode(F.split("line", " ")).alias("pos", "token")).filter("token <> '<*>'")
    tokens = tokens.select(*LINE, "pos", F.xxhash64("token").alias("token"))
    counts = tokens.groupBy("leaf", "pos", "token").agg(F.count("*").alias("c")).filter(F.col("c") >= MIN_TEXTS)
    placed = F.sort_array(F.collect_list(F.struct("pos", "token", "c")))
    common = tokens.join(counts, ["leaf", "pos", "token"]).groupBy(*LINE).agg(placed.alias("at"))

    def templates(at: Column) -> Column:
        def template(least: Column) -> Column:
            kept = F.filter(at, lambda x: x["c"] >= least)
            constant = 10 * F.size(kept) >= MIN_CONSTANT * F.col("n")
            return F.when(constant, F.xxhash64("leaf", F.transform(kept, lambda x: F.struct(x["pos"], x["token"]))))

        return F.filter(F.transform(F.array_distinct(F.transform(at, lambda x: x["c"])), template), lambda h: h.isNotNull())

    common = common.filter(10 * F.size("at") >= MIN_CONSTANT * F.col("n"))
    found = cut(common.select(*LINE, F.explode(let(F.col("at"), templates)).alias("general")), "general")
    return (found.join(_recurring(found, "general"), "general").groupBy("key", "line_no", "leaf")
            .agg(F.max(~F.col("doc_id").eqNullSafe(F.col("first_id"))).alias("gone")))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, dropped): the numbers of the lines to drop, by document key."""
    # Parsed once; readers of the table take the fields they need.
    full = cut(_lines(docs, id_col, text_col), "lines")
    lines = full.select("doc_id", "key", "text_hash", "line_no", "p.n", "p.tpl", "p.leaf").filter("tpl is not null")
    known = cut(_recurring(lines, "tpl", LONG_TEXTS), "templates")
    drops = _to_drop(lines, known, "tpl")

    rest = lines.join(known, "tpl", "left_anti")
    leaves = cut(_recurring(rest, "leaf").select("leaf"), "leaves")
    if not leaves.isEmpty():
        open_lines = full.select("doc_id", "key", "text_hash", "line_no", "p.n", "p.tpl", "p.leaf", "p.line").join(leaves, "leaf", "left_semi")
        open_lines = cut(open_lines.join(known, "tpl", "left_anti").dropDuplicates(["key", "line_no"]).select(*LINE, "line"), "leaf-lines")
        while True:
            members = cut(_general(open_lines), "members")
            if members.isEmpty():
                break
            drops = drops.unionByName(members.filter("gone").select("key", "line_no"))
            # Counts change only in the leaves that lost lines.
            open_lines = open_lines.join(members.select("leaf").distinct(), "leaf", "left_semi").join(members, ["key", "line_no"], "left_anti")
            open_lines = cut(open_lines, "leaf-lines")
    return drops.groupBy("key").agg(F.collect_set("line_no").alias("dropped"))


def drop_recurring_templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with its texts less the dropped lines; other columns stay as
    they are. With ``counts`` also n_lines and n_dropped, in place of columns of these names."""
    doc, key, gone = fresh(docs, "doc_key", "drop_key", "gone")
    drops = dropped_lines(docs, id_col, text_col).select(F.col("key").alias(key), F.col("dropped").alias(gone))
    joined = docs.withColumn(doc, _key(id_col, text_col)).join(drops, F.col(doc) == F.col(key), "left")
    text = F.col(text_col).cast("string")

    def without(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
        return F.array_join(F.transform(F.sort_array(left), lambda i: F.get(lines, i)), "\n")

    cleaned = F.when(F.col(gone).isNull(), text).otherwise(let(F.split(text, "\n"), without))
    more = {"n_lines": F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("long"),
            "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("long")} if counts else {}
    more = {k: F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.greatest(v, F.lit(0).cast("long"))) for k, v in more.items()}
    return joined.withColumns(more | {text_col: cleaned}).drop(doc, key, gone)


OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, text, dense_rank() OVER (ORDER BY doc_id, text) AS k, string_split(text, chr(10)) AS ls FROM documents),
raw AS (
  SELECT k, doc_id, md5(text) AS th, i AS line_no, ls[i] AS line
  FROM (SELECT DISTINCT * FROM d), unnest(range(1, len(ls) + 1)) AS t(i)),
tok AS (SELECT k, doc_id, th, line_no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM raw),
masked AS (
  SELECT *, list_transform(ws, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS toks
  FROM tok WHERE len(ws) >= 2),
lines AS (
  SELECT k, doc_id, th, line_no, toks, len(toks) AS n, len(toks) || chr(10) || array_to_string(toks[1:4], ' ') AS leaf,
    array_to_string(CASE WHEN 2 * len(list_filter(toks, lambda x: x = '<*>')) < len(toks) THEN toks ELSE ws END, ' ') AS tpl
  FROM masked),
known AS (
  SELECT tpl, min(doc_id) AS first_id FROM lines
  GROUP BY tpl HAVING count(DISTINCT th) >= CASE WHEN max(n) > 50 THEN 2 ELSE 5 END),
rest AS (SELECT * FROM lines WHERE tpl NOT IN (SELECT tpl FROM known)),
step AS (  -- lines of leaves still open, and those that a round found a template for
  SELECT k, doc_id, th, line_no, toks, n, leaf, 'open' AS state FROM rest
  WHERE leaf IN (SELECT leaf FROM rest GROUP BY leaf HAVING count(DISTINCT th) >= 5)
  UNION ALL (
    WITH here AS (SELECT * FROM step WHERE state = 'open'),
    t AS (SELECT k, line_no, leaf, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM here),
    counts AS (SELECT leaf, pos, token, count(*) AS c FROM t WHERE token <> '<*>' GROUP BY leaf, pos, token HAVING count(*) >= 5),
    placed AS (
      SELECT k, line_no, list({'pos': pos, 'token': token, 'c': c} ORDER BY pos) AS kept
      FROM t JOIN counts USING (leaf, pos, token) GROUP BY k, line_no),
    tries AS (
      SELECT h.k, h.doc_id, h.th, h.line_no, h.leaf, h.n, kept, unnest(list_distinct(list_transform(kept, lambda x: x.c))) AS least
      FROM placed JOIN here h USING (k, line_no)),
    general AS (
      SELECT k, doc_id, th, line_no, leaf || chr(10) ||
        array_to_string(list_transform(list_filter(kept, lambda x: x.c >= least), lambda x: x.pos || ':' || x.token), ' ') AS g
      FROM tries WHERE 10 * len(list_filter(kept, lambda x: x.c >= least)) >= 7 * n),
    found AS (SELECT g, min(doc_id) AS first_id FROM general GROUP BY g HAVING count(DISTINCT th) >= 5),
    members AS (
      SELECT k, line_no, bool_or(doc_id IS DISTINCT FROM first_id) AS gone FROM general JOIN found USING (g) GROUP BY k, line_no)
    SELECT h.k, h.doc_id, h.th, h.line_no, h.toks, h.n, h.leaf,
      CASE WHEN m.k IS NULL THEN 'open' WHEN m.gone THEN 'gone' ELSE 'stays' END
    FROM here h LEFT JOIN members m ON m.k = h.k AND m.line_no = h.line_no
    WHERE h.leaf IN (SELECT leaf FROM here JOIN members USING (k, line_no))
  )),
drops AS (
  SELECT k, line_no FROM lines JOIN known USING (tpl) WHERE doc_id IS DISTINCT FROM first_id
  UNION SELECT k, line_no FROM step WHERE state = 'gone'),
per AS (SELECT k, list(line_no) AS gone FROM drops GROUP BY k)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped,
  md5(CASE WHEN gone IS NULL THEN text
    ELSE coalesce(array_to_string(list_filter(ls, lambda x, i: NOT list_contains(gone, i)), chr(10)), '') END) AS kept_md5
FROM d LEFT JOIN per USING (k)
"""
