"""The search index on disk: postings in document blocks, vocabulary and documents as Parquet."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.functions.text import excerpt, to_number
from textlens.functions.vectors import vector_values
from textlens.operators.scoring import (
    DocumentBlock,
    QueryBlock,
    document_blocks,
    numbered_queries,
    query_blocks,
    ranked,
    score_in_blocks,
    search_vectors,
)
from textlens.operators.tfidf import TfidfModel, TfidfSettings, fit_tfidf

# With so few different query terms their ids go into the scan filter.
PUSHED_TERMS = 1000
# A saved document is numbered by its block and its place there; blocks are numbered by partition and count.
PLACE_BITS, COUNT_BITS = 16, 24


@dataclass
class SearchIndex:
    model: TfidfModel
    documents: DataFrame
    # Document vectors, or of a saved index: postings (term_id, block, peak, places, weights) by term, and
    # blocks (block, doc_ids), blocks being numbered in the order of ids.
    vectors: DataFrame | None = None
    postings: DataFrame | None = None
    blocks: DataFrame | None = None

    def search(self, queries: DataFrame, top_k: int = 5) -> DataFrame:
        """(query_id, query, rank, score, doc_id) for (query_id, query), ids of any type, also repeated ones.

        One kernel scores blocks of queries against blocks of documents (see operators/scoring.py): next to the
        documents where they are vectorised in the same job, else over the saved postings of the asked terms, which
        meet by block, packed as they are.
        """
        if self.vectors is not None:
            return search_vectors(self.vectors, self.model, queries, top_k)
        numbered = numbered_queries(queries)
        found = score_in_blocks(self.postings, saved_blocks, query_blocks(self.model, numbered), top_k, "long", _asked_by_block)
        first = self.blocks.select("block", F.posexplode("doc_ids").alias("place", "doc_id")).orderBy("block", "place").limit(top_k)
        first = [(r["block"] << PLACE_BITS) + r["place"] for r in first.collect()]
        best = ranked(found, numbered, top_k, first)
        best = best.withColumns({"block": F.shiftright("doc_id", PLACE_BITS), "place": F.col("doc_id").bitwiseAND((1 << PLACE_BITS) - 1)})
        named = best.drop("doc_id").join(self.blocks, "block")
        return named.select("query_id", "query", "rank", "score", F.expr("doc_ids[place]").alias("doc_id"))

    def n_postings(self) -> DataFrame:
        if self.vectors is not None:
            return self.vectors.agg(F.coalesce(F.sum(F.size(vector_values("features"))), F.lit(0)).alias("n_postings"))
        return self.postings.agg(F.coalesce(F.sum(F.size("places")), F.lit(0)).alias("n_postings"))

    def statistics(self) -> DataFrame:
        """One row: documents, terms, postings and the settings of the index."""
        settings = self.model.settings
        return self.n_postings().select(
            F.lit(self.model.n_docs).alias("n_documents"),
            F.lit(len(self.model.terms)).alias("n_terms"),
            "n_postings",
            F.lit(settings.bigrams).alias("use_bigrams"),
            F.lit(settings.min_df).alias("min_df"),
            F.lit(settings.max_df).alias("max_df"),
            F.lit(settings.max_features).alias("max_features"),
        )


def _asked_by_block(postings: DataFrame, queries: QueryBlock) -> DataFrame:
    """Postings of the queries' terms, together by block. Few terms reach the scan as a filter, so that their row groups
    alone are read; more are looked up in a table of all terms."""
    ids = queries.terms.tolist()
    if len(ids) <= PUSHED_TERMS:
        postings = postings.filter(F.col("term_id").isin(*ids)) if ids else postings.limit(0)
    else:
        wanted = postings.sparkSession.sparkContext.broadcast(queries.terms)

        def only_asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(np.isin(batch.column("term_id").to_numpy(), wanted.value)))

        postings = postings.mapInArrow(only_asked, postings.schema)
    return postings.repartition("block").sortWithinPartitions("block", "term_id")


def saved_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[DocumentBlock]:
    """Document blocks of saved postings, sorted by block and term. Ids are numbers of saved documents."""
    parts: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        numbers = batch.column("block").to_numpy()
        cuts = np.flatnonzero(numbers[1:] != numbers[:-1]) + 1
        for low, high in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
            if high > low:
                if parts and numbers[low] != current:
                    yield _block(current, parts)
                    parts = []
                current = numbers[low]
                parts.append(batch.slice(low, high - low))
    if parts:
        yield _block(current, parts)


def _block(number: int, parts: list[pa.RecordBatch]) -> DocumentBlock:
    rows = pa.Table.from_batches(parts).combine_chunks()
    column = {c: rows.column(c).combine_chunks() for c in ("term_id", "peak", "places", "weights")}
    places = column["places"].flatten().to_numpy()
    starts = np.concatenate([[0], np.cumsum(column["places"].value_lengths().to_numpy())])
    ids = pa.array((int(number) << PLACE_BITS) + np.arange(places.max() + 1))
    return DocumentBlock(ids, column["term_id"].to_numpy(), starts, places, column["weights"].flatten().to_numpy(), column["peak"].to_numpy())


def index_documents(cleaned: DataFrame, text_column: str = "review_text") -> DataFrame:
    """(doc_id, hotel_name, reviewer_score, text_excerpt) of cleaned review rows."""
    return cleaned.select(
        "doc_id",
        F.coalesce("Hotel_Name", F.lit("")).alias("hotel_name"),
        to_number("Reviewer_Score").alias("reviewer_score"),
        excerpt(text_column).alias("text_excerpt"),
    )


def build_index(
    cleaned: DataFrame, text_column: str = "review_text", settings: TfidfSettings = TfidfSettings(min_df=3, max_features=30_000)
) -> SearchIndex:
    model = fit_tfidf(cleaned, settings)
    vectors = model.with_vectors(cleaned.select("doc_id", "clean_text")).select("doc_id", "features")
    return SearchIndex(model, index_documents(cleaned, text_column), vectors)


def packed_blocks(vectors: DataFrame, model: TfidfModel) -> DataFrame:
    """Rows of document blocks over ranges of ids: one with doc_ids, and one for each of the block's terms."""
    raw = F.unwrap_udt("features")
    rows = vectors.select("doc_id", raw["indices"].alias("positions"), raw["values"].alias("weights"))
    ids = rows.sparkSession.sparkContext.broadcast(model.term_ids)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << COUNT_BITS
        for k, block in enumerate(document_blocks(batches, ids.value)):
            n = len(block.terms)
            docs = pa.ListArray.from_arrays(pa.array([0, len(block.ids)], pa.int32()), block.ids)
            lists = [pa.ListArray.from_arrays(pa.array(block.starts, pa.int32()), pa.array(x)) for x in (block.places.astype(np.int32), block.weights)]
            number = pa.array([first + k], pa.int64())
            none = [pa.nulls(1, t) for t in (pa.int32(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float64()))]
            names = ["block", "term_id", "peak", "places", "weights", "doc_ids"]
            yield pa.RecordBatch.from_arrays([number, *none, docs], names=names)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, first + k)), pa.array(block.terms.astype(np.int32)), pa.array(block.peaks), *lists, pa.nulls(n, docs.type)], names=names)

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(run, f"block long, term_id int, peak double, places array<int>, weights array<double>, doc_ids array<{kind}>")


def save_index(index: SearchIndex, path: str, mode: str = "overwrite") -> None:
    """Postings are sorted by (term, block) over all files, so a query reads the row groups of its terms; a term found in
    most documents spreads over many files."""
    if index.vectors is None:
        raise ValueError("This index is a saved one: copy its files.")
    spark = index.documents.sparkSession
    packed = packed_blocks(index.vectors, index.model).persist(StorageLevel.MEMORY_AND_DISK)
    packed.filter("doc_ids IS NOT NULL").select("block", "doc_ids").write.mode(mode).parquet(f"{path}/blocks")
    postings = packed.filter("doc_ids IS NULL").select("term_id", "block", "peak", "places", "weights")
    postings.repartitionByRange("term_id", "block").sortWithinPartitions("term_id", "block").write.mode(mode).parquet(f"{path}/postings")
    packed.unpersist()
    index.documents.write.mode(mode).parquet(f"{path}/documents")
    index.model.vocabulary(spark).write.mode(mode).parquet(f"{path}/vocabulary")
    settings = index.model.settings
    spark.createDataFrame(
        [
            (
                index.model.n_docs,
                settings.min_df,
                settings.max_df,
                settings.max_features,
                settings.bigrams,
                list(settings.stop_words),
            )
        ],
        "n_docs long, min_df int, max_df double, max_features int, bigrams boolean, stop_words array<string>",
    ).write.mode(mode).parquet(f"{path}/settings")


def load_index(spark: SparkSession, path: str) -> SearchIndex:
    saved = spark.read.parquet(f"{path}/settings").head()
    # As many rows as max_features allows: the vocabulary is part of the model.
    words = spark.read.parquet(f"{path}/vocabulary").orderBy("term_id").collect()
    settings = TfidfSettings(
        saved["min_df"], saved["max_df"], saved["max_features"], saved["bigrams"], tuple(saved["stop_words"])
    )
    model = TfidfModel(
        settings,
        saved["n_docs"],
        [w["term"] for w in words],
        [w["df"] for w in words],
        [w["ctf"] for w in words],
    )
    postings, blocks = (spark.read.parquet(f"{path}/{part}") for part in ("postings", "blocks"))
    return SearchIndex(model, spark.read.parquet(f"{path}/documents"), postings=postings, blocks=blocks)
