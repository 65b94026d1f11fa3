"""Similarity search over reviews."""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.functions.constants import DEFAULT_QUERIES
from textlens.operators.preparation import cleaned_rows, row_funnel
from textlens.operators.sampling import exact_sample
from textlens.operators.search import query_summary, search, with_document_columns
from textlens.operators.tfidf import TfidfSettings
from textlens.sources.index import SearchIndex, build_index
from textlens.sources.reviews import queries_from_list


@dataclass(frozen=True)
class RetrievalSettings:
    sample_size: int | None = 20_000
    text_column: str = "review_text"
    top_k: int = 5
    tfidf: TfidfSettings = TfidfSettings(min_df=3, max_df=0.9, max_features=30_000)
    seed: int = 42


def find_similar(
    reviews: DataFrame, query: str | None = None, doc_id: int | None = None, settings: RetrievalSettings = RetrievalSettings()
) -> DataFrame:
    """(rank, score, doc_id, text) for one free text or one document; the text is the cleaned one."""
    if query is None and doc_id is None:
        raise ValueError("Give either a query or a document id.")
    sampled = exact_sample(reviews, settings.sample_size, settings.seed)
    docs = cleaned_rows(sampled, settings.text_column).select("doc_id", "clean_text")
    return search(docs, query, doc_id, settings.top_k, settings.tfidf)


@dataclass
class QueryBatch:
    index: SearchIndex
    results: DataFrame
    reviews: DataFrame
    settings: RetrievalSettings
    n_queries: int

    def examples(self) -> DataFrame:
        return with_document_columns(self.results, self.index.documents)

    def summary(self) -> DataFrame:
        return query_summary(self.results)

    def metadata(self) -> DataFrame:
        """One row: row counts, settings and size of the index."""
        counts = row_funnel(self.reviews, self.settings.text_column, None).select(
            "rows_loaded", "rows_after_text_filter", "rows_after_cleaning"
        )
        model, tfidf = self.index.model, self.settings.tfidf
        return counts.select(
            "*",
            F.lit(self.settings.text_column).alias("text_column"),
            F.lit(self.settings.top_k).alias("top_k"),
            F.lit(tfidf.bigrams).alias("use_bigrams"),
            F.lit(tfidf.min_df).alias("min_df"),
            F.lit(tfidf.max_df).alias("max_df"),
            F.lit(tfidf.max_features).alias("max_features"),
            F.array(F.lit(model.n_docs), F.lit(len(model.terms))).alias("matrix_shape"),
            F.lit(self.n_queries).alias("n_queries"),
        )


def index_reviews(reviews: DataFrame, settings: RetrievalSettings = RetrievalSettings()) -> SearchIndex:
    sampled = exact_sample(reviews, settings.sample_size, settings.seed)
    return build_index(cleaned_rows(sampled, settings.text_column), settings.text_column, settings.tfidf)


def run_queries(
    reviews: DataFrame,
    queries: DataFrame | Iterable[str] = DEFAULT_QUERIES,
    settings: RetrievalSettings = RetrievalSettings(),
) -> QueryBatch:
    """Many queries over one index: (query_id, query) rows or a list of texts."""
    sampled = exact_sample(reviews, settings.sample_size, settings.seed)
    index = build_index(cleaned_rows(sampled, settings.text_column), settings.text_column, settings.tfidf)
    if not isinstance(queries, DataFrame):
        queries = queries_from_list(reviews.sparkSession, queries)
    results = index.search(queries, settings.top_k)
    return QueryBatch(index, results, sampled, settings, queries.count())
