"""A corpus from raw documents: quality rules, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents as they
are, whatever else a table carries. Between stages the table is written as Parquet and read again. Nulls: a null text is
an empty one. A null doc_id is an id of its own that comes last. Empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlens.llm.decontamination import contamination
from textlens.llm.line_dedup import without_repeated_lines
from textlens.llm.near_dedup import near_duplicates
from textlens.llm.packing import pack_pieces, token_pieces
from textlens.llm.quality import with_quality
from textlens.llm.shared import KEY, stored, table, with_key

#: SQL has no suffix arrays and no tokenizer, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts have too few words and go."""
    return with_quality(docs).filter("_quality.kept").select(*map(_named, docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that ten or more of them share; n_chars follows the text. No document goes: one that
    loses all its lines stays with an empty text."""
    kept = without_repeated_lines(docs, min_documents=10)
    new = {"text": F.col("_kept_text"), "n_chars": F.when(F.col("_n_dropped") > 0, F.length("_kept_text").cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return kept.select(*(new[c].cast(docs.schema[c].dataType).alias(c) if new.get(c) is not None else _named(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document by id of each component of near copies (five-word shingles, similarity 0.8), one row of it.
    Texts without words are no copies of one another and stay, but rows with equal id and text are one document."""
    first = near_duplicates(docs, size=5, percent=80).filter("is_first").select(*KEY).distinct()
    kept = with_key(docs).join(first, list(KEY), "left_semi")
    once = Window.partitionBy(*KEY).orderBy(*KEY)
    return kept.withColumn("_nth_copy", F.row_number().over(once)).filter("_nth_copy = 1").select(*map(_named, docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in 13-word windows of benchmark items."""
    hit = contamination(docs, table(spark, sf_dir, "benchmark"), window=13, share=0.05).filter("contaminated").select(*KEY)
    return with_key(docs).join(hit, list(KEY), "left_anti").select(*map(_named, docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of at most 2048 tokens."""
    return pack_pieces(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), most=2048), capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]


def _named(column: str):
    return F.col(f"`{column}`")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
