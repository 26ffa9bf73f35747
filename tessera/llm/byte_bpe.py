"""Byte-level BPE encoding and decoding with recursive DuckDB queries.

Spark deals out the documents; inside each task the distinct pieces of a
chunk of texts (matches of the split pattern, kept separate) go to an
in-process DuckDB as rows (word, pos, token), one row for each byte. A
recursive query joins neighbouring tokens to the merge table and contracts
each word's leftmost pair of minimum rank until no pair merges. Ordered
aggregation then puts the ids of a word in sequence and decodes them, and a
document is the sequence of its pieces. A word that the rank file holds whole
is that one token, as in the library whose files these are.

Pieces over ``LONG_PIECE`` bytes take a second form of the query that
contracts every non-overlapping occurrence of the minimum rank in one step.
It does so only for merges whose result starts no merge of a lower rank, for
which the order of occurrences cannot matter; other merges go one at a time.
Both forms stop after some steps and are called again on what is unfinished,
so the rows that a recursion holds are bounded.

Defined cases: NULL and empty texts have no ids and decode to no bytes.
Repeated rows give repeated results. Extra columns of the input are ignored.
"""

from __future__ import annotations

import base64
import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG_PIECE = 96
# Letters, numbers and white space among the code points below 256.
LATIN = {
    r"\p{L}": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff",
    r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe",
    r"\s": "\t-\r \x85\xa0",
}
# Characters of text looked at together, words in one recursive query, rows
# that one call of it may produce, pieces remembered by a task, and the memory of its DuckDB.
CHUNK_CHARS = 1_000_000
WORDS_AT_ONCE = 20_000
ROWS_AT_ONCE = 3_000_000
REMEMBERED = 400_000
DUCKDB_MEMORY = "150MB"

_STEPS = """
CREATE OR REPLACE TEMP TABLE steps AS
WITH RECURSIVE step(it, word, pos, tok) AS (
  SELECT 0, word, pos, tok FROM todo
  UNION ALL (
    WITH side AS (
      SELECT it, word, pos, tok, lead(tok) OVER w AS tok2, lead(pos) OVER w AS pos2
      FROM step WINDOW w AS (PARTITION BY word ORDER BY pos)),
    ranked AS (
      SELECT s.*, m.r FROM side s JOIN merges m ON m.ab = s.tok::BIGINT * {base} + s.tok2),
    best AS (
      SELECT word, min(r::BIGINT * 4294967296 + pos) AS rp, arg_min(pos2, r::BIGINT * 4294967296 + pos) AS gone
      FROM ranked GROUP BY word)
    SELECT it + 1, s.word, s.pos, CASE WHEN s.pos = rp % 4294967296 THEN (rp // 4294967296)::INT ELSE s.tok END
    FROM step s JOIN best USING (word) WHERE s.pos <> gone AND s.it < {most})
)
SELECT * FROM step
"""

_LONG_STEPS = """
CREATE OR REPLACE TEMP TABLE steps AS
WITH RECURSIVE step(it, word, pos, tok) AS (
  SELECT 0, word, pos, tok FROM todo
  UNION ALL (
    WITH side AS (
      SELECT it, word, pos, tok, lead(tok) OVER w AS tok2, lead(pos) OVER w AS pos2, row_number() OVER w AS i
      FROM step WINDOW w AS (PARTITION BY word ORDER BY pos)),
    ranked AS (
      SELECT s.*, m.r, m.free FROM side s JOIN merges m ON m.ab = s.tok::BIGINT * {base} + s.tok2),
    best AS (SELECT word, min(r) AS r, min(pos) AS lo FROM ranked
             WHERE (word, r) IN (SELECT (word, min(r)) FROM ranked GROUP BY word) GROUP BY word),
    hits AS (
      SELECT k.word, k.pos, k.pos2, k.r, k.free, b.lo, i - row_number() OVER (PARTITION BY k.word ORDER BY k.pos) AS run, i
      FROM ranked k JOIN best b ON b.word = k.word AND b.r = k.r),
    chosen AS (
      SELECT word, pos, pos2, r FROM (
        SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY pos) AS nth FROM hits)
      WHERE CASE WHEN free THEN nth % 2 = 1 ELSE pos = lo END)
    SELECT s.it + 1, s.word, s.pos, coalesce(c.r, s.tok)
    FROM step s JOIN best USING (word)
    LEFT JOIN chosen c ON c.word = s.word AND c.pos = s.pos
    LEFT JOIN chosen g ON g.word = s.word AND g.pos2 = s.pos
    WHERE g.word IS NULL AND s.it < {most})
)
SELECT * FROM step
"""

_LEFT = """
SELECT word, pos, tok, it = {most} AS more
FROM steps JOIN (SELECT word, max(it) AS it FROM steps GROUP BY word) USING (word, it)
"""

_COLLECT = """
SELECT word, list(tok) AS ids, string_agg(hex, '') AS hexes
FROM (SELECT word, tok, hex FROM final JOIN vocab USING (tok) ORDER BY word, pos) GROUP BY word
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def latin_pattern(pattern: str) -> str | None:
    """``pattern`` for Python's faster ``re``, right for texts of code points
    below 256 only: the Unicode classes are spelled out for these. None if it
    uses anything else that ``re`` lacks."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        found = re.compile(r"\\p\{[LN]\}|\\[sS]|\\.|[\[\]]|[^\\\[\]]").match(pattern, at)
        part, at = found[0], found.end()
        if part in LATIN:
            out.append(LATIN[part] if inside else f"[{LATIN[part]}]")
        elif part == r"\S" and not inside:
            out.append(f"[^{LATIN[chr(92) + 's']}]")
        elif part[0] == "\\":
            return None
        else:
            inside = part == "[" or inside and part != "]"
            out.append(part)
    return "".join(out)


def merge_table(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """ab (left token * base + right token), r (rank of the pair), free."""
    rows = [(ranks[a], ranks[b], r) for whole, r in ranks.items() if len(whole) > 1
            for i in range(1, len(whole)) if (a := whole[:i]) in ranks and (b := whole[i:]) in ranks]
    a, b, r = np.array(rows, np.int64).reshape(-1, 3).T
    # A token is bound if some merge that it takes part in has a lower rank than its own.
    bound = set(a[r < a].tolist()) | set(b[r < b].tolist())
    return {"ab": a * (max(ranks.values()) + 1) + b, "r": r.astype(np.int32), "free": np.array([x not in bound for x in r.tolist()], bool)}


class BytePairs:
    """The merge table and vocabulary in a DuckDB of this process, until closed."""

    def __init__(self, ranks: dict[bytes, int], merges: dict[str, np.ndarray], pattern: str):
        import duckdb

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        narrow = latin_pattern(pattern)
        self.latin = re.compile(narrow) if narrow else None
        self.base = max(ranks.values()) + 1
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET temp_directory = ''")  # never a local folder of the executor
        self.db.execute(f"SET memory_limit = '{DUCKDB_MEMORY}'")
        self._table("merges", merges)
        self._table("vocab", {"tok": np.array(list(ranks.values()), np.int32), "hex": [t.hex() for t in ranks]})

    def close(self) -> None:
        self.db.close()
        pa.default_memory_pool().release_unused()
        try:  # glibc keeps freed memory otherwise, and the process lives on
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, in order."""
        if self.latin is not None:
            try:
                text.encode("latin-1")
                return self.latin.findall(text)
            except UnicodeEncodeError:
                pass
        return self.pattern.findall(text)

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _merge(self, words: list[bytes], steps: str) -> pa.Table:
        """(word, pos, tok): what is left of each word when no pair merges."""
        lens = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        rows = pa.table({"word": np.repeat(np.arange(len(words), dtype=np.int32), lens),
                         "pos": (np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32),
                         "tok": self.of_byte[flat]})
        done = []
        while rows.num_rows:
            most = int(np.clip(ROWS_AT_ONCE // rows.num_rows, 1, 256))
            self.db.register("todo", rows)
            self.db.execute(steps.format(base=self.base, most=most))
            out = self.db.sql(_LEFT.format(most=most)).to_arrow_table()
            self.db.unregister("todo")
            more = out.column("more")
            done.append(out.filter(pc.invert(more)).select(["word", "pos", "tok"]))
            rows = out.filter(more).select(["word", "pos", "tok"])
        return pa.concat_tables(done)

    def _finish(self, words: list[bytes], final: pa.Table, into: dict[bytes, bytes]) -> None:
        self.db.register("final", final)
        out = self.db.sql(_COLLECT).to_arrow_table()
        self.db.unregister("final")
        ids = out.column("ids").combine_chunks()
        flat, ends = ids.flatten().to_numpy().astype("<i4"), ids.offsets.to_numpy()
        hexes = out.column("hexes").to_pylist()
        packed, ends = flat.tobytes(), (ends * 4).tolist()
        for n, at in enumerate(out.column("word").to_pylist()):
            word, decoded = words[at], bytes.fromhex(hexes[n])
            if decoded != word:
                raise ValueError(f"ids of {word!r} decode to {decoded!r}")
            into[word] = packed[ends[n] : ends[n + 1]]

    def encode(self, pieces: list[str]) -> dict[str, bytes]:
        """piece -> its ids as little-endian int32, which decode to the piece's bytes."""
        found: dict[bytes, bytes] = {}
        whole, short, long = [], [], []
        for piece in pieces:
            raw = piece.encode()
            (whole if raw in self.ranks else short if len(raw) <= LONG_PIECE else long).append(raw)
        for at in range(0, len(whole), WORDS_AT_ONCE):
            part = whole[at : at + WORDS_AT_ONCE]
            self._finish(part, pa.table({"word": np.arange(len(part), dtype=np.int32), "pos": np.zeros(len(part), np.int32),
                                         "tok": np.array([self.ranks[w] for w in part], np.int32)}), found)
        for at in range(0, len(short), WORDS_AT_ONCE):
            part = short[at : at + WORDS_AT_ONCE]
            self._finish(part, self._merge(part, _STEPS), found)
        long.sort(key=len)
        while long:
            part, size = [], 0
            while long and (not part or size + len(long[-1]) <= ROWS_AT_ONCE // 64):
                part.append(long.pop())
                size += len(part[-1])
            self._finish(part, self._merge(part, _LONG_STEPS), found)
        return {piece: found[piece.encode()] for piece in pieces}


def _encoder(path: str, pattern: str):
    ranks = read_ranks(path)
    merges = merge_table(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Built for each task and closed with it: the process serves other stages after it.
        bpe = BytePairs(ranks, merges, pattern)
        try:
            yield from encoded(bpe, batches)
        finally:
            bpe.close()

    def encoded(bpe: BytePairs, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = bpe.split
        known: dict[str, bytes] = {}
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, size, start = [], 0, at
                while at < batch.num_rows and (not texts or size < CHUNK_CHARS):
                    texts.append(batch.column(1)[at].as_py() or "")
                    size += len(texts[-1])
                    at += 1
                if len(known) > REMEMBERED:
                    known.clear()
                pieces = [split(t) for t in texts]
                known |= bpe.encode(list(set().union(*pieces) - known.keys()))
                ids, decoded, lens = [], [], []
                for doc in pieces:
                    ids.append(b"".join([known[p] for p in doc]))
                    # Each piece's ids were decoded and are its bytes, no more and no less.
                    decoded.append("".join(doc).encode())
                    lens.append(len(ids[-1]) // 4)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                offsets = pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32))
                yield pa.record_batch([batch.column(0).slice(start, at - start), pa.array(lens, pa.int64()),
                                       pa.ListArray.from_arrays(offsets, values), pa.array(decoded, pa.binary())],
                                      names=["doc_id", "n_tokens", "ids", "decoded"])

    return run


def encode_and_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (array of int), decoded
    (the bytes those ids stand for). ``path`` is a file of base64 token and
    rank lines, read here and sent to the tasks (its size is that of the
    vocabulary); ``pattern`` splits texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encoder(path, pattern), "doc_id long, n_tokens long, ids array<int>, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the comma-joined ids and of the decoded bytes."""
    return encoded.select(
        "doc_id", "n_tokens", F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
