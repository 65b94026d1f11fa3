"""TF-IDF: vocabulary fit, document vectors, postings.

A fit is one pass over the texts: terms are counted with map-side combine and only the chosen terms
come to the driver (``max_features`` of them at most; they are the model). Document vectors are then a
narrow transformation.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, ElementwiseProduct, NGram, Normalizer
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.functions.constants import ENGLISH_STOP_WORDS
from textlens.functions.text import word_tokens
from textlens.functions.vectors import vector_entries
from textlens.functions.words import term_counts, text_parts


# A term table of this many rows takes a few tens of megabytes; only smaller ones are broadcast.
BROADCAST_TERMS = 1_000_000


@dataclass(frozen=True)
class TfidfSettings:
    min_df: int = 5
    max_df: float = 0.9
    max_features: int = 50_000
    bigrams: bool = False
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS


def vectorizer_settings(settings: TfidfSettings) -> Column:
    """The settings as a struct, for reports of runs."""
    return F.struct(
        F.lit("tfidf").alias("method"),
        F.lit("english" if settings.stop_words == ENGLISH_STOP_WORDS else "own").alias("stop_words"),
        F.array(F.lit(1), F.lit(2 if settings.bigrams else 1)).alias("ngram_range"),
        F.lit(settings.min_df).alias("min_df"),
        F.lit(settings.max_df).alias("max_df"),
        F.lit(settings.max_features).alias("max_features"),
    )


def with_terms(df: DataFrame, settings: TfidfSettings, text: str = "clean_text", out: str = "terms") -> DataFrame:
    """Add the terms of every text: words, and with ``bigrams`` also pairs of words.

    Stop words go first, so a pair may bridge a dropped word.
    """
    df = df.withColumn(out, word_tokens(text, settings.stop_words))
    if not settings.bigrams:
        return df
    df = NGram(n=2, inputCol=out, outputCol="__pairs").transform(df)
    return df.withColumn(out, F.concat(out, "__pairs")).drop("__pairs")


def term_frequencies(df: DataFrame, settings: TfidfSettings, text: str = "clean_text") -> DataFrame:
    """(doc_id, term, tf) for every term of every row: run lengths of the row's sorted terms, so nothing moves. Rows
    that share a doc_id are counted each on its own."""
    rows = with_terms(df.select("doc_id", text), settings, text).select("doc_id", F.array_sort("terms").alias("terms"))
    last = F.size("terms") - 1
    # Places where another term begins, and the end.
    begins = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (F.get("terms", i) != F.get("terms", i - 1)))
    rows = rows.filter(last >= 0).select("doc_id", "terms", F.concat(begins, F.array(last + 1)).alias("at"))
    count = F.size("at") - 1
    runs = F.transform(
        F.slice("at", F.lit(1), count),
        lambda b, k: F.struct(F.get("terms", b).alias("term"), (F.get("at", k + 1) - b).cast("long").alias("tf")),
    )
    return rows.select("doc_id", F.explode(runs).alias("run")).select("doc_id", "run.term", "run.tf")


def term_statistics(df: DataFrame, settings: TfidfSettings, text: str = "clean_text") -> DataFrame:
    """(term, df, ctf): document and corpus counts. The row with a null term counts the documents.

    Tasks split and count the words of some MB of text at a time with Arrow; only each part's distinct terms reach the
    grouped count.
    """
    stop_words, bigrams = settings.stop_words, settings.bigrams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_parts(batch.column(0)):
                yield term_counts(texts, stop_words, bigrams)

    counts = df.select(text).mapInArrow(run, "term string, df long, ctf long")
    return counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf"))


def _most_frequent(candidates: DataFrame, limit: int) -> list:
    """The ``limit`` rows with the largest ctf (ties: term), as driver rows.

    Terms are first counted by the logarithm of their ctf. Only the classes needed to reach the limit
    are sorted, so the last task of the sort gets little more than ``limit`` rows.
    """
    level = F.floor(F.log2("ctf") * 8).cast("int")
    sizes = candidates.groupBy(level.alias("level")).count().collect()
    found, lowest = 0, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        found, lowest = found + row["count"], row["level"]
        if found >= limit:
            break
    if lowest is None:
        return []
    kept = candidates.filter(level >= lowest)
    if found > limit:
        kept = kept.orderBy(F.desc("ctf"), "term").limit(limit)
    return kept.collect()


@dataclass
class TfidfModel:
    """A fitted vocabulary. ``terms`` is alphabetical: the place in it is the term id."""

    settings: TfidfSettings
    n_docs: int
    terms: list[str]
    df: list[int]
    ctf: list[int]
    _indexer: CountVectorizerModel | None = field(default=None, repr=False)
    _term_ids: np.ndarray | None = field(default=None, repr=False)

    @property
    def idf(self) -> np.ndarray:
        return np.log((1 + self.n_docs) / (1 + np.asarray(self.df, dtype=float))) + 1

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        """(term_id, term, df, ctf, idf)"""
        rows = zip(range(len(self.terms)), self.terms, self.df, self.ctf, self.idf.tolist())
        return spark.createDataFrame(
            list(rows), "term_id int, term string, df long, ctf long, idf double"
        )

    def _prepare(self, spark: SparkSession) -> None:
        # CountVectorizer numbers equally frequent terms in an order of its own; ``_term_ids`` maps
        # its positions to ours. All terms are one row: handed over in one piece, one by one they take seconds.
        if self._indexer is not None:
            return
        rows = spark.createDataFrame([(self.terms,)], "terms array<string>").coalesce(1)
        self._indexer = CountVectorizer(
            inputCol="terms", outputCol="__counts", vocabSize=max(len(self.terms), 1), minDF=1.0
        ).fit(rows)
        place = {t: i for i, t in enumerate(self.terms)}
        self._term_ids = np.array([place[t] for t in self._indexer.vocabulary], dtype=int)

    @property
    def term_ids(self) -> np.ndarray:
        """Term id of each vector position, once vectors were made."""
        return self._term_ids

    @property
    def position_terms(self) -> list[str]:
        """Terms by vector position."""
        return [self.terms[i] for i in self._term_ids]

    def _counted(self, df: DataFrame, text: str) -> DataFrame:
        """Add ``__counts``. Terms that the vocabulary lacks do not count, so stop words and letters need to go only where
        pairs may bridge them, or where the vocabulary has some."""
        self._prepare(df.sparkSession)
        if self.settings.bigrams or any(len(t) < 2 for t in self.terms) or not set(self.settings.stop_words).isdisjoint(self.terms):
            rows = with_terms(df, self.settings, text)
        else:
            rows = df.withColumn("terms", F.split(text, " "))
        return self._indexer.transform(rows)

    def with_vectors(self, df: DataFrame, text: str = "clean_text", out: str = "features") -> DataFrame:
        """Add the L2-normalised TF-IDF vector of every text. Narrow; unknown terms are ignored and
        a text without known terms gets a zero vector."""
        columns = df.columns
        counted = self._counted(df, text)
        weighted = ElementwiseProduct(
            scalingVec=DenseVector(self.idf[self._term_ids]), inputCol="__counts", outputCol="__weights"
        ).transform(counted)
        return Normalizer(p=2.0, inputCol="__weights", outputCol=out).transform(weighted).select(
            *columns, out
        )

    def with_counts(self, df: DataFrame, text: str = "clean_text", out: str = "counts") -> DataFrame:
        """Add the vector of term counts of every text."""
        columns = df.columns
        return self._counted(df, text).select(*columns, F.col("__counts").alias(out))

    def positions(self, spark: SparkSession) -> DataFrame:
        """(position, term_id, term): at most ``max_features`` rows."""
        self._prepare(spark)
        rows = [(p, int(i), self.terms[i]) for p, i in enumerate(self._term_ids)]
        return spark.createDataFrame(rows, "position int, term_id int, term string")

    def postings(self, vectors: DataFrame, features: str = "features") -> DataFrame:
        """(doc_id, term_id, term, weight) of documents with vectors."""
        entries = vectors.select("doc_id", F.explode(vector_entries(features)).alias("entry")).select(
            "doc_id", F.col("entry.position").alias("position"), F.col("entry.value").alias("weight")
        )
        names = self.positions(vectors.sparkSession)
        if len(self.terms) <= BROADCAST_TERMS:
            names = F.broadcast(names)
        return entries.join(names, "position").select("doc_id", "term_id", "term", "weight")


def fit_tfidf(docs: DataFrame, settings: TfidfSettings = TfidfSettings(), text: str = "clean_text") -> TfidfModel:
    """Choose the vocabulary of ``docs`` by document frequency and corpus count."""
    if settings.max_features < 1:
        raise ValueError("max_features has to be at least 1.")
    stats = term_statistics(docs, settings, text)
    # Rare terms are most of a vocabulary; the null row holds the number of documents.
    stats = stats.filter(F.col("term").isNull() | (F.col("df") >= settings.min_df))
    # A kept table has all shuffle partitions, however small, and three jobs read it: a few a core are enough.
    stats = stats.coalesce(4 * max(1, docs.sparkSession.sparkContext.defaultParallelism)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counted = stats.filter(F.col("term").isNull()).collect()
        n_docs = counted[0]["df"] if counted else 0
        if settings.max_df * n_docs < settings.min_df:
            raise ValueError("max_df allows fewer documents than min_df demands.")
        candidates = stats.filter(
            F.col("term").isNotNull() & (F.col("df") <= F.lit(float(settings.max_df * n_docs)))
        )
        rows = _most_frequent(candidates, settings.max_features)
    finally:
        stats.unpersist()
    if not rows:
        raise ValueError("No terms remain. Lower min_df or raise max_df.")
    rows.sort(key=lambda r: r["term"])
    return TfidfModel(
        settings,
        n_docs,
        [r["term"] for r in rows],
        [r["df"] for r in rows],
        [r["ctf"] for r in rows],
    )

