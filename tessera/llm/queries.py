"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    byte_bpe,
    hash_tree,
    language_codes,
    line_templates,
    near_dedup,
    oracle_sql,
    pairwise_quality,
    periodic_runs,
    prefix_trie,
    quality_rules,
    secret_crf,
    token_counts,
    trie_sql,
    warc,
    winnowing,
    winnowing_sql,
)
from tessera.llm.common import WORD, doc_hash, let, load, new_folder

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
TOKENIZER_FILE = "byte_bpe_50k.json"


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_codes.identify(load(spark, sf_dir, "documents"))


def op3_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.assign_shards(load(spark, sf_dir, "documents"))


def op4_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_archives(load(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "segments", "whole")


def op5_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op6_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return pairwise_quality.score(docs, pairwise_quality.fit(docs, load(spark, sf_dir, "labels")))


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_templates.drop_recurring_templates(load(spark, sf_dir, "documents"), counts=True)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op9_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_crf.digests(secret_crf.scan(load(spark, sf_dir, "documents")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(byte_bpe.encode_and_decode(
        load(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN))


def made_periodic(text: Column, doc_id: str) -> Column:
    """``text``, but where a tenth of the ids' checksums end in 0, its words from
    some place on repeat the next p: word i >= a becomes word a + (i - a) % p."""
    def rewrite(words: Column) -> Column:
        n = F.size(words)
        g = F.floor(doc_hash(doc_id) / 10).cast("long")
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
        return let(F.struct(words.alias("w"), a.alias("a"), p.alias("p")), lambda s: F.array_join(F.transform(
            F.sequence(F.lit(0), F.size(s["w"]) - 1), lambda i: F.get(s["w"], F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]))), " "))

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.when((doc_hash(doc_id) % 10 == 0) & text.rlike(WORD), let(words, rewrite)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return periodic_runs.summary(periodic_runs.periodic_runs(docs, text_col=made_periodic(F.col("text"), "doc_id")))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_FILE), limit=512)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.conversation_turns(load(spark, sf_dir, "conversations"))
    rebuilt = prefix_trie.rebuild(own, every=20, most=3, heads=lambda c: doc_hash(c) % 4)
    return prefix_trie.trie_nodes(rebuilt)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_language_codes": op2_language_codes,
    "op3_hash_tree_sharding": op3_hash_tree_sharding,
    "op4_warc_segments": op4_warc_segments,
    "op5_winnowing_decontamination": op5_winnowing_decontamination,
    "op6_divergence_rules": op6_divergence_rules,
    "op7_pairwise_quality": op7_pairwise_quality,
    "op8_line_templates": op8_line_templates,
    "op9_secret_crf": op9_secret_crf,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": oracle_sql.OP1,
    "op3_hash_tree_sharding": oracle_sql.OP3,
    "op4_warc_segments": oracle_sql.OP4,
    "op5_winnowing_decontamination": winnowing_sql.OP5,
    "op8_line_templates": line_templates.OP8,
    "op13_prefix_trie": trie_sql.OP13,
}
