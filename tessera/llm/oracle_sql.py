"""DuckDB SQL of the results of op1, op3 and op4, each by a plainer way than
its operator's: pairs of shared shingles, draws of all shards, payload counts."""

from tessera.llm import hash_tree, warc

# Words of a lower-cased text, and its distinct 5-word shingles (the whole of a shorter one).
OP1 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^ \t\n\x0B\f\r]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, s.b FROM reach r JOIN sides s ON s.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""


def _crc_steps() -> list[int]:
    """The CRC-32 of each byte, by the rule: eight shifts, with the polynomial where a 1 leaves."""
    steps = list(range(256))
    for _ in range(8):
        steps = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in steps]
    return steps


_TEXT_CRC = ("xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT), "
             f"lambda c, y: xor(c >> 8, ({_crc_steps()}::BIGINT[])[(xor(c, y) & 255) + 1])), 4294967295)")


def _first_digits(of: str) -> str:
    return f"('0x' || substr(md5({of}), 1, 13))::BIGINT"


OP3 = f"""
WITH texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
crcs AS (SELECT text, CASE WHEN text = '' THEN 0 ELSE {_TEXT_CRC} END AS text_crc32 FROM texts),
sized AS (
  SELECT doc_id, octet_length(encode(text)) + {hash_tree.ROW_OVERHEAD} AS size, text_crc32, coalesce(doc_id::VARCHAR, 'null') AS key
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) JOIN crcs USING (text)),
draws AS (
  SELECT key, shard, -ln(({_first_digits("key || '/shard/' || shard")} + 0.5) / {hash_tree.HASH_SPAN!r}) AS draw
  FROM (SELECT DISTINCT key FROM sized), range(0, {hash_tree.SHARDS + 1}) AS t(shard)),
placed AS (
  SELECT key, arg_min(shard, draw) FILTER (shard < {hash_tree.SHARDS}) AS shard, arg_min(shard, draw) AS grown_shard FROM draws GROUP BY key)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard // {hash_tree.SHARDS_PER_REGION} AS INTEGER) AS region,
  CAST(shard // {hash_tree.SHARDS_PER_RACK} AS INTEGER) AS rack, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY {_first_digits("key || '/slot'")} % {hash_tree.SLOT_BUCKETS}, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM sized JOIN placed USING (key)
"""

_HEAD = len(warc.HTTP_HEAD)
OP4 = f"""
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
first AS (SELECT h, n, min(page_id) AS first_id FROM p GROUP BY h, n),
fives AS (
  SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(h, 1 + 5 * i, 5))::BIGINT) AS f FROM p JOIN first USING (h, n)),
framed AS (
  SELECT *, {_HEAD} + n // {warc.CHUNK_BYTES} * ({warc.CHUNK_BYTES} + {len(f"{warc.CHUNK_BYTES:x}") + 4})
    + CASE WHEN n % {warc.CHUNK_BYTES} = 0 THEN 0 ELSE n % {warc.CHUNK_BYTES} + length(to_hex(n % {warc.CHUNK_BYTES})) + 4 END + 5 AS block
  FROM fives)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(f, lambda v: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> s) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
  CASE WHEN page_id = first_id THEN (block + {warc.SEGMENT_BYTES - 1}) // {warc.SEGMENT_BYTES} ELSE 1 END AS segments, true AS whole
FROM framed
"""
