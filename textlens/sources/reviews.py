"""Review tables: read from CSV, or derived from the document and label tables."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlens.functions.constants import NEGATIVE_PLACEHOLDERS, POSITIVE_PLACEHOLDERS
from textlens.functions.text import (
    LINE_END,
    blank_placeholders,
    na_to_null,
    normalize_whitespace,
    strip,
)
from textlens.sources.csv_records import read_csv_in_ranges

TEXT_COLUMNS = ("review_text", "positive_text", "negative_text")


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"The table lacks the column(s) {', '.join(missing)}.")


def read_reviews_csv(
    spark: SparkSession, path: str | list[str], *, multi_line: bool = True, id_column: str | None = None
) -> DataFrame:
    """Reviews from CSV with a header; every column is a string, missing-value strings are null.

    Quoted fields may hold line breaks and doubled quotes; large files are read by many tasks all the same (see
    csv_records.py). With ``multi_line=False``, for files known to have no line breaks in fields, Spark's own reader cuts
    at lines. ``doc_id`` is the given id column, or else a hash of the row's file name and content, so it depends
    neither on the cluster nor on how files are split. Equal rows of one file have equal ids; draws and
    splits treat them one by one.
    """
    if multi_line:
        raw = read_csv_in_ranges(spark, path)
        file, names = F.col("file"), raw.columns[1:]
    else:
        raw = spark.read.options(header=True, quote='"', escape='"').csv(path)
        file, names = F.element_at(F.split(F.input_file_name(), "/"), -1), raw.columns
    columns = [na_to_null(F.col(f"`{c}`")).alias(c) for c in names]
    if id_column:
        return spread(raw.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), *columns))
    parts = [file]
    for c in names:  # a null differs from every text
        parts += [F.col(f"`{c}`").isNull(), F.col(f"`{c}`")]
    return spread(raw.select(F.xxhash64(*parts).alias("doc_id"), *columns))


#: A table with fewer bytes for each core may sit in a few splits, and moving it costs each core no more than this.
SPREAD_BYTES = 128 << 20


def spread(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Repartition a small table by row id: its rows may fill fewer tasks than the cluster has cores.

    The bytes of the table decide, not its splits, of which some hold no rows. A large table passes through
    unchanged, without a shuffle. No result depends on it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores, key) if size < cores * SPREAD_BYTES else df


def reviews_from_documents(documents: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Review rows from documents: first line = praise, other lines = complaint, quality = score.

    Without ``labels`` the score column is left out and no join is needed.
    """
    first = F.substring_index("text", "\n", 1)
    has_more = F.contains("text", F.lit("\n"))
    rows = documents
    if labels is not None:
        rows = documents.join(labels.select("doc_id", "quality"), "doc_id", "left")
    even = F.col("doc_id") % 2 == 0
    columns = [
        "doc_id",
        F.col("source").alias("Hotel_Name"),
        F.when(F.col("doc_id") % 7 == 0, "No Positive").otherwise(first).alias("Positive_Review"),
        F.when(has_more, F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)"))
        .otherwise("No Negative")
        .alias("Negative_Review"),
    ]
    if labels is not None:
        columns.append(
            F.when(F.col("doc_id") % 50 == 0, "n/a")
            .when(F.col("quality") == 1, F.when(even, "9.6").otherwise("8.0"))
            .when(F.col("quality") == 0, F.when(even, "3.3").otherwise("5.0"))
            .otherwise("6.5")
            .alias("Reviewer_Score")
        )
    return rows.select(*columns)


def with_text_columns(df: DataFrame) -> DataFrame:
    """Blank the placeholders and add review_text, negative_text and positive_text."""
    require_columns(df, ["Positive_Review", "Negative_Review"])
    blanked = df.withColumns(
        {
            "Positive_Review": blank_placeholders("Positive_Review", POSITIVE_PLACEHOLDERS),
            "Negative_Review": blank_placeholders("Negative_Review", NEGATIVE_PLACEHOLDERS),
        }
    )
    return blanked.withColumns(
        {
            "review_text": normalize_whitespace(
                F.concat_ws(" ", "Positive_Review", "Negative_Review")
            ),
            "negative_text": normalize_whitespace("Negative_Review"),
            "positive_text": normalize_whitespace("Positive_Review"),
        }
    )


def read_queries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(query_id, query) from text files with one query per line; blank lines are dropped.

    Lines are read by line, also from large files, and numbered from 1 by file name and place: per-task
    counts shift the numbers, so no task sees all lines.
    """
    rows = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row"), "value")
    lines = rows.select("file", "row", F.posexplode(F.split("value", LINE_END)).alias("pos", "query"))
    lines = lines.withColumn("query", strip("query")).filter(F.col("query") != "")
    numbered = lines.withColumn("part", F.struct("file", F.shiftright("row", 33)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file and task.
    parts = numbered.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("row", "pos")
    queries = numbered.join(parts, "part").select(
        (F.row_number().over(within) + F.col("before")).cast("int").alias("query_id"), "query"
    )
    if queries.isEmpty():
        raise ValueError(f"No line of {path} holds a query.")
    return queries


def queries_from_list(spark: SparkSession, queries: Iterable[str]) -> DataFrame:
    rows = list(enumerate(queries, start=1))
    if not rows:
        raise ValueError("The query list is empty.")
    return spark.createDataFrame(rows, "query_id int, query string")
