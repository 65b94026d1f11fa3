"""CSV files with line breaks in quoted fields, read in byte ranges by many tasks.

Outside quotes the number of quotes so far is even, and a doubled quote does not change that. So a line ends a record if
the quotes up to it are even. Each byte range of a file sums up its quotes; prefix sums of the few sums say whether a range
begins within quotes; then every task cuts its own lines into records. Only the pieces of records that cross the border of
a range, two for each range at most, move.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Text that a task hands over at a time.
BATCH_BYTES = 4 << 20
RECORDS = "file string, start long, piece int, first boolean, record string"
# Kinds of pieces: the end or the middle of a record of an earlier range, a whole record, the beginning of one.
LATER, WHOLE, BEGUN = 0, 1, 2


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of rows (file, start, within, quotes, value), the lines of one byte range after the other."""
    out: list[tuple] = []
    held: list[str] = []
    size = 0
    place = within = first = None

    def rows() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in RECORDS.split(", ")])

    for batch in batches:
        for *here, inside, quotes, line in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "within", "quotes", "value")), strict=True):
            if here != place:
                if held:
                    out.append((*place, LATER if begun_before else BEGUN, first, "\n".join(held)))
                place, within, begun_before, first, held = here, inside, inside, here[1] == 0, []
            held.append(line)
            size += len(line)
            within ^= bool(quotes % 2)
            if not within:
                out.append((*place, LATER if begun_before else WHOLE, first, "\n".join(held)))
                held, begun_before, first = [], False, False
        if size >= BATCH_BYTES and out:
            yield rows()
            out, size = [], 0
    if held:
        out.append((*place, LATER if begun_before else BEGUN, first, "\n".join(held)))
    if out:
        yield rows()


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, first, record): the records of CSV files as text, without the line break at their end. `first` marks the
    first record of a file. Lines end with \\n or \\r\\n. Quotes stand around fields and are doubled within; a file that
    leaves one open has a last record that reaches to its end. Empty lines between records are left out."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        "value",
    )
    # A row for each byte range. `within`: the quotes of all ranges before it in its file are odd.
    sums = lines.groupBy("file", "start").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.select("file", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("within"))
    # Lines stay in order where they are: the ranges, as many as the splits of the scan, go to them.
    cut = lines.join(F.broadcast(ranges), ["file", "start"]).select("file", "start", "within", "quotes", "value").mapInArrow(_cut, RECORDS)
    whole = cut.filter(F.col("piece") == WHOLE).select("file", "first", "record")
    pieces = cut.filter(F.col("piece") != WHOLE)
    # A range's pieces in order: what ends an earlier record, then what begins one.
    order = Window.partitionBy("file").orderBy("start", "piece")
    chained = pieces.withColumn("chain", F.sum(F.when(F.col("piece") == BEGUN, 1).otherwise(0)).over(order))
    joined = chained.groupBy("file", "chain").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece", "first", "record"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    joined = joined.select("file", F.col("parts")[0]["first"].alias("first"), text.alias("record"))
    every = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return every.filter(F.col("record") != "")


def read_csv_in_ranges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Columns of CSV files with a header, all strings, and `file`, the name of a row's file. Every file begins with the
    header; the first one names the columns."""
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    names = spark.read.options(header=True, **options).csv(path).columns
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
    rows = csv_records(spark, path).filter(~F.col("first"))
    parsed = rows.select(F.element_at(F.split("file", "/"), -1).alias("file"), F.from_csv("record", schema, options).alias("row"))
    return parsed.select("file", *(F.col("row").getField(c).alias(c) for c in names))
