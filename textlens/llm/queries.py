"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm.shared import table

VOCABULARY = "word_bpe_49k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.token_counts import token_counts

    docs = table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", token_counts(spark, F.col("text"), public_tokenizers.path(VOCABULARY)).alias("c"))
    return counted.select("doc_id", "c.n_words", "c.n_tokens")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.packing import pack_pieces, token_pieces

    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), most=2048)
    return pack_pieces(pieces, capacity=2048)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.line_dedup import without_repeated_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce("_kept_text", F.lit("")), 256)
    return without_repeated_lines(docs, min_documents=10).select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), kept.alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.quality import with_quality

    return with_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "_quality.*")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.suffix_dedup import without_earlier_substrings

    found = without_earlier_substrings(table(spark, sf_dir, "documents"), size=50)
    return found.select("doc_id", F.col("n_symbols").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.sharding import shard_documents

    placed = shard_documents(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.pii import listed, personal_data

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", personal_data(docs, F.col("text")).alias("p"))

    def number(kind: str):
        return F.size(F.filter("p.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    every = listed(F.concat("p.base", "p.added")).alias("spans")
    return found.select("doc_id", *map(number, ("email", "ip", "card", "phone")), F.sha2(listed(F.col("p.base")), 256).alias("base_sha256"), every)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.substring_dedup import without_repeated_passages

    found = without_repeated_passages(table(spark, sf_dir, "documents"), size=35)
    return found.select("doc_id", F.col("n_symbols").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.near_dedup import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.decontamination import contamination

    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = contamination(docs, items, window=13, share=0.05)
    ids = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), ids, "contaminated")


def op11_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.spelling import spelling_variants

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants(docs, least_letters=6, least_count=5, factor=5, every=199)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.jaccard_join import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"), size=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textlens.llm.prefix_trie import prefix_trie, with_borrowed_starts

    return prefix_trie(with_borrowed_starts(table(spark, sf_dir, "conversations"), block=20, most=3))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_sharding": op6_sharding,
    "op7_pii": op7_pii,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_pivotal_grams": op11_pivotal_grams,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_prefix_trie": op13_prefix_trie,
}
