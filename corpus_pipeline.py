"""A corpus pipeline: five stages over ``documents``, each one an operator of
``tessera.llm``. Every stage reads the Parquet that the one before it wrote.

Defined cases, for every stage and for ``run``: an empty table gives no rows.
Columns of any other name are passed on untouched by all stages but the last. NULL, empty
and letterless texts have no language and go in the first stage. Repeated rows (same id and text) are
judged alike by each stage; near-dedup keeps one of them. NULL ids are ids like others, but never name a
group that has any other. A benchmark without rows or words contaminates nothing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, language_codes, line_templates, near_dedup, winnowing
from tessera.llm.common import cut, load


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with an ambiguous one, go: so do NULL,
    empty and letterless texts."""
    return language_codes.drop_undetermined(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go; n_chars follows the
    text. No document goes; a text may become empty."""
    cleaned = line_templates.drop_recurring_templates(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of smallest id.
    Texts without words are copies of nothing and stay."""
    return near_dedup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more are in benchmark
    windows go; items without words mark nothing."""
    return winnowing.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes; a text that
    line dedup emptied has 0 tokens."""
    return byte_bpe.digests(byte_bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: a row for each document that is kept. Each
    stage's table stays in the shared folder, as the next one and the result read it."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return cut(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])


# The learned language model and near copies by component are beyond SQL.
ORACLE_SQL = None
