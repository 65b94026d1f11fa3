"""Line deduplication over range-partitioned line hashes; decisions leave as bitmaps of lines to keep."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.shared import BLANKS, KEY, checkpointed, hash128, lowered, with_key

LINE = ("_line_a", "_line_b")
EDGE = pa.schema([("part", pa.int32()), *((x, pa.int64()) for x in ("a", "b", "docs", "doc_a", "doc_b", "end_a", "end_b"))])
DROPPED = pa.schema([(KEY[0], pa.int64()), (KEY[1], pa.int64()), ("_at", pa.int32()), ("_lines", pa.int32())])


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each line that has a key: hash of the key, document, position."""
    keyed = with_key(docs.select("doc_id", "text"))
    split = keyed.select(*KEY, F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("_all"))
    lines = split.select(*KEY, F.size("_all").alias("_lines"), F.posexplode("_all").alias("_at", "_line"))
    lines = lines.withColumn("_line", F.btrim(lowered(F.col("_line")), F.lit(BLANKS))).filter(F.length("_line") > 0)
    a, b = hash128(F.col("_line"))
    return lines.select(a.alias(LINE[0]), b.alias(LINE[1]), *KEY, "_at", "_lines")


def _runs(batch: pa.RecordBatch, last: tuple | None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Which rows begin a new line hash, which a new document of it, given the row before the batch."""
    a, b, da, db = (batch.column(i).to_numpy() for i in range(4))

    def changed(x: np.ndarray, before) -> np.ndarray:
        return np.concatenate([[before is None or x[0] != before], x[1:] != x[:-1]])

    before = last or (None,) * 4
    line = changed(a, before[0]) | changed(b, before[1])
    return line, line | changed(da, before[2]) | changed(db, before[3]), [a, b, da, db]


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's first and last line hash: documents in this partition, the first and the last of them."""
    last, runs = None, []  # the first and the present run, as [a, b, docs, first document, last document]
    for batch in batches:
        if batch.num_rows == 0:
            continue
        line, doc, (a, b, da, db) = _runs(batch, last)
        last = (a[-1], b[-1], da[-1], db[-1])
        begins = np.flatnonzero(line)
        seen = np.concatenate([[0], np.cumsum(doc)])
        goes_on = begins[0] if len(begins) else batch.num_rows
        if goes_on:
            runs[-1][2] += seen[goes_on]
            runs[-1][5:] = [da[goes_on - 1], db[goes_on - 1]]
        for i in sorted({0, len(begins) - 1}) if len(begins) else ():
            start, end = begins[i], begins[i + 1] if i + 1 < len(begins) else batch.num_rows
            runs.append([a[start], b[start], seen[end] - seen[start], da[start], db[start], da[end - 1], db[end - 1]])
        runs = [runs[0], runs[-1]] if len(runs) > 1 else runs
    if runs:
        columns = zip(*([TaskContext.get().partitionId(), *map(int, r)] for r in runs), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, EDGE, strict=True)], schema=EDGE)


def _decide(totals: dict[tuple[int, int], int], opening: dict[int, tuple[int, int, int, int]], least: int, keep_first: bool):
    """Stream sorted lines and give back those to drop.

    totals: documents of the hashes at partitions' edges, over all partitions. opening: for a partition that begins
    inside a hash, that hash and the document before.
    """

    def rows(batch: pa.RecordBatch, chosen: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(batch.filter(pa.array(chosen)).columns[2:], schema=DROPPED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = opening.get(TaskContext.get().partitionId())
        held: list[pa.RecordBatch] = []  # rows of the present hash, as long as it has too few documents
        docs = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            line, doc, (a, b, da, db) = _runs(batch, last)
            last = (a[-1], b[-1], da[-1], db[-1])
            run_of = np.cumsum(line)  # 0: the hash goes on from before
            count = np.bincount(run_of, weights=doc).astype(np.int64)
            count[0] += docs
            for row in (0, len(a) - 1):
                count[run_of[row]] = totals.get((int(a[row]), int(b[row])), count[run_of[row]])
            if run_of[0] == 0 and count[0] >= least:
                yield from held
                held = []
            if run_of[-1] != 0:
                held = []
            spared = line if keep_first else np.zeros(len(line), bool)
            out = (count[run_of] >= least) & ~spared
            if out.any():
                yield rows(batch, out)
            docs = int(count[run_of[-1]])
            waits = (run_of == run_of[-1]) & ~spared
            if docs < least and waits.any():
                held.append(rows(batch, waits))

    return run


def _bitmap(dropped: pd.Series, lines: pd.Series) -> pd.Series:
    def one(at, n: int) -> bytes:
        keep = np.ones(n, np.uint8)
        keep[np.asarray(at, np.int64)] = 0
        return zlib.compress(np.packbits(keep).tobytes(), 6)

    return pd.Series([one(at, n) for at, n in zip(dropped, lines, strict=True)], dtype=object)


def _kept_text(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def one(text: str | None, bits: bytes | None) -> str | None:
        if bits is None:
            return text
        lines = (text or "").split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=len(lines))
        return "\n".join(x for x, k in zip(lines, keep, strict=True) if k)

    return pd.Series([one(t, b) for t, b in zip(text, bitmap, strict=True)], dtype=object)


def line_bitmaps(docs: DataFrame, min_documents: int = 10, keep_first: bool = False, partitions: int | None = None) -> DataFrame:
    """Of each document that loses lines: its key (two longs), `_bitmap` of lines to keep, `_n_dropped`.

    A line's key is the line without white space at its ends and with A-Z in lower case; lines without a key stay.
    Keys found in at least `min_documents` documents lose all their lines, or, with `keep_first`, all but the first
    by document key and position. A bitmap is zlib over one bit a line, highest bit first, 1 for lines to keep.

    Lines are range-partitioned by (hash, document, position), so a line that is everywhere covers several
    partitions and no task takes it alone. What partitions share, their first and last hash, is counted from two
    rows of each. Rows with the same doc_id and text count as one document. Null or empty texts have one empty line,
    which stays; an empty table gives no rows.
    """
    spark = docs.sparkSession
    wanted = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [*LINE, *KEY, "_at"]
    sorted_lines = checkpointed(_lines(docs).repartitionByRange(wanted, *columns).sortWithinPartitions(*columns))

    # Two rows for each partition at most, however many lines there are.
    ddl = ", ".join(f"{x.name} {'int' if x.type == pa.int32() else 'long'}" for x in EDGE)
    rows = sorted(map(tuple, sorted_lines.mapInArrow(_edges, ddl).collect()))
    totals: dict[tuple[int, int], int] = {}
    opening: dict[int, tuple[int, int, int, int]] = {}
    before = None
    for part, a, b, docs_here, first_a, first_b, end_a, end_b in rows:
        same = before is not None and before[:2] == (a, b)
        shared = same and before[2:] == (first_a, first_b)
        totals[a, b] = totals.get((a, b), 0) + docs_here - int(shared)
        if same:
            opening[part] = before
        before = (a, b, end_a, end_b)
    dropped = sorted_lines.mapInArrow(_decide(totals, opening, min_documents, keep_first), f"{KEY[0]} long, {KEY[1]} long, _at int, _lines int")
    lost = dropped.groupBy(*KEY).agg(F.collect_set("_at").alias("_lost"), F.max("_lines").alias("_lines"))
    return lost.select(*KEY, F.pandas_udf(_bitmap, "binary")("_lost", "_lines").alias("_bitmap"), F.size("_lost").cast("long").alias("_n_dropped"))


def without_repeated_lines(docs: DataFrame, min_documents: int = 10, keep_first: bool = False) -> DataFrame:
    """Documents with `_bitmap` (null: all lines stay), `_n_lines`, `_n_dropped` and `_kept_text`, besides their own columns."""
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    joined = with_key(docs).join(line_bitmaps(docs, min_documents, keep_first), list(KEY), "left")
    kept = F.when(F.col("_bitmap").isNull(), F.col("text")).otherwise(F.pandas_udf(_kept_text, "string")("text", "_bitmap"))
    return joined.select(*docs.columns, "_bitmap", lines.alias("_n_lines"), F.coalesce("_n_dropped", F.lit(0)).cast("long").alias("_n_dropped"), kept.alias("_kept_text"))
