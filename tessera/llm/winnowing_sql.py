"""Oracle SQL of op5: every 13-word window of every text, without winnowing."""

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, {WORDS} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p + 1 : p + least(len(w), 13)], ' ') AS win
  FROM i, unnest(range(0, greatest(len(w) - 12, 1))) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT row_no, p, n, array_to_string(w[p + 1 : p + n], ' ') AS win
  FROM d, sizes, unnest(range(0, len(w) - n + 1)) AS t(p) WHERE len(w) >= n),
hit AS (SELECT row_no, p, dw.n AS n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
words AS (SELECT row_no, count(DISTINCT pos) AS n_hit FROM (SELECT row_no, unnest(range(p, p + n)) AS pos FROM hit) GROUP BY row_no),
named AS (SELECT row_no, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM hit GROUP BY row_no)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (row_no) LEFT JOIN named USING (row_no)
"""
