"""Similarity search by TF-IDF cosine: one query or one document; results of many queries."""

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlens.functions.rows import only_rows_of
from textlens.functions.text import clean_text
from textlens.functions.vectors import with_dot_products
from textlens.operators.tfidf import TfidfModel, TfidfSettings, fit_tfidf


# A result of up to this many rows is brought to the driver to look its texts up by id.
FETCHED_ROWS = 1000

def _ranked(scored: DataFrame, top_k: int) -> DataFrame:
    """(rank, score, doc_id, text): a top-k of narrow rows, then the texts of the k winners."""
    best = (
        scored.select("doc_id", "score").orderBy(F.desc(F.round("score", 6)), "doc_id").limit(top_k)
    )
    order = Window.partitionBy().orderBy(F.desc(F.round("score", 6)), "doc_id")
    return best.select(F.row_number().over(order).alias("rank"), "score", "doc_id")


def _with_texts(best: DataFrame, texts: DataFrame, text: str, top_k: int) -> DataFrame:
    texts = texts.select("doc_id", F.col(text).alias("text"))
    if top_k <= FETCHED_ROWS:
        # The ids of the few winners reach the scan as a filter: their texts alone are read and cleaned.
        rows = best.collect()
        texts = texts.filter(F.col("doc_id").isin([r["doc_id"] for r in rows]))
        best = F.broadcast(texts.sparkSession.createDataFrame(rows, best.schema))
    return texts.join(best, "doc_id").select("rank", "score", "doc_id", "text").orderBy("rank")


def _query_vector(model: TfidfModel, df: DataFrame, query: str) -> np.ndarray:
    row = df.sparkSession.createDataFrame([(query,)], "query string").select(
        clean_text("query").alias("clean_text")
    )
    return model.with_vectors(row).head()["features"].toArray()


def search_by_query(
    docs: DataFrame, query: str, top_k: int = 5, settings: TfidfSettings = TfidfSettings(min_df=3, max_features=30_000)
) -> DataFrame:
    """Fit on ``docs`` (doc_id, clean_text) and rank them by cosine with a free text.

    All ``top_k`` rows come back, also at score 0. Texts are scored where they lie.
    """
    model = fit_tfidf(docs, settings)
    target = _query_vector(model, docs, query)
    vectors = model.with_vectors(docs.select("doc_id", "clean_text"))
    scored = with_dot_products(vectors, "features", target[None, :], "score").withColumn(
        "score", F.col("score")[0]
    )
    return _with_texts(_ranked(scored, top_k), docs, "clean_text", top_k)


def search_by_row(
    docs: DataFrame, doc_id: int, top_k: int = 5, settings: TfidfSettings = TfidfSettings(min_df=3, max_features=30_000)
) -> DataFrame:
    """As search_by_query, with a document of the table as the query; it ranks itself last (-1)."""
    model = fit_tfidf(docs, settings)
    vectors = model.with_vectors(docs.select("doc_id", "clean_text"))
    found = vectors.filter(F.col("doc_id") == doc_id).head()
    if found is None:
        raise IndexError(f"There is no document {doc_id} in the table.")
    target = found["features"].toArray()
    scored = with_dot_products(vectors, "features", target[None, :], "score").withColumn(
        "score", F.when(F.col("doc_id") == doc_id, -1.0).otherwise(F.col("score")[0])
    )
    return _with_texts(_ranked(scored, top_k), docs, "clean_text", top_k)


def search(
    docs: DataFrame,
    query: str | None = None,
    doc_id: int | None = None,
    top_k: int = 5,
    settings: TfidfSettings = TfidfSettings(min_df=3, max_features=30_000),
) -> DataFrame:
    if query is not None:
        return search_by_query(docs, query, top_k, settings)
    if doc_id is None:
        raise ValueError("Give either a query or a document id.")
    return search_by_row(docs, doc_id, top_k, settings)


def with_document_columns(results: DataFrame, documents: DataFrame) -> DataFrame:
    """Add hotel_name, reviewer_score and text_excerpt of the found documents."""
    # top_k rows per query, read once to pick the documents and once to join them.
    results = results.persist(StorageLevel.MEMORY_AND_DISK)
    return results.join(only_rows_of(documents, results), "doc_id").select(
        "query_id", "query", "rank", "score", "doc_id", "hotel_name", "reviewer_score", "text_excerpt"
    )


def query_summary(results: DataFrame) -> DataFrame:
    """(query_id, query, top_score, mean_top_k_score), best first."""
    return (
        results.groupBy("query_id", "query")
        .agg(F.max("score").alias("top_score"), F.avg("score").alias("mean_top_k_score"))
        .orderBy(F.desc(F.round("top_score", 6)), F.desc(F.round("mean_top_k_score", 6)), "query_id")
    )
