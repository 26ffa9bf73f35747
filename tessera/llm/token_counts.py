"""Token counts without the tokens: batch encoding in Arrow functions that
return lengths only.

Spark deals out the documents. A task loads the tokenizer once and encodes
parts of its texts in batches of about ``BATCH_BYTES``: short texts share a
batch, a text of over ``PART_BYTES`` is cut into parts first, so a batch never
grows with a text. Parts are cut further at white space, where that is safe,
and a batch encodes every different unit once; the counts of units up to
``SHORT`` characters are remembered for the next batches, up to ``REMEMBERED``
of them. Ids are never turned into Python lists nor sent to Spark; a
document's count is the sum over its units.

A cut is safe where the tokenizer's own split pattern always ends a piece.
With the byte-level pattern no piece holds white space after another
character, nor a letter beside a digit, so a cut before ASCII white space that
follows other text, or between an ASCII letter and an ASCII digit,
changes no piece on either side; nor does one between a Han or kana letter
and the full stops and commas written with these. Tokenizers with another
splitter, with a normalizer or with an added token that holds such a place are
never cut: their texts are encoded whole. A stretch without a safe place stays
in one part, however long.

Defined cases: NULL and empty texts have 0 bytes and 0 tokens. Strings of
special tokens inside a text count as the library takes them by default (one
token). Repeated rows give repeated results; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1_000_000
PART_BYTES = 200_000
SHORT = 40
REMEMBERED = 400_000
SAFE = re.compile(r"(?<=\S)(?=[ \t-\r])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[ぁ-ゖァ-ヺ一-鿿])(?=[、。！，？])")

# White space with what follows it, up to the next ASCII white space after another character.
UNIT = re.compile(r"[ \t-\r]*[^ \t-\r]+(?:(?<=\s)[ \t-\r]+[^ \t-\r]*)*|[ \t-\r]+")


def may_cut(tokenizer_json: str) -> bool:
    """Whether texts may be cut at the places of ``SAFE`` for this tokenizer."""
    spec = json.loads(tokenizer_json)
    splitter = spec.get("pre_tokenizer") or {}
    plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
    return bool(plain and spec.get("normalizer") is None and not any(
        SAFE.search(t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens") or []))


def cut_text(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut at safe places only."""
    at = 0
    while len(text) - at > size:
        place = SAFE.search(text, at + size)
        if place is None:
            break
        yield text[at : place.start()]
        at = place.start()
    yield text[at:]


def _counter(path: str, batch_bytes: int, part_bytes: int, remembered: int = REMEMBERED):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as spec:
            cut = may_cut(spec.read())
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        known: dict[str, int] = {}

        for batch in batches:
            n_tokens = np.zeros(batch.num_rows, np.int64)
            parts: list[str] = []
            owners: list[int] = []
            held = 0

            def encode():
                units = [UNIT.findall(part) if cut else [part] for part in parts]
                new = list(set().union(*units) - known.keys())
                known.update(zip(new, map(len, tokenizer.encode_batch_fast(new, add_special_tokens=False))))
                np.add.at(n_tokens, owners, [sum(map(known.__getitem__, u)) for u in units])
                for unit in new:
                    if len(unit) > SHORT:
                        del known[unit]
                if len(known) > remembered:
                    known.clear()
                parts.clear()
                owners.clear()

            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py()
                if not text:
                    continue
                for part in cut_text(text, part_bytes) if cut and len(text) > part_bytes else (text,):
                    if parts and held + len(part) > batch_bytes:
                        encode()
                        held = 0
                    parts.append(part)
                    owners.append(row)
                    held += len(part)
            if parts:
                encode()
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(n_tokens)], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
                 batch_bytes: int = BATCH_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit
    (more than ``limit`` tokens). ``path`` is a tokenizer file (.json) that
    every executor can read; no token is added, cut off or padded."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = rows.mapInArrow(_counter(path, batch_bytes, part_bytes), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
