"""Helpers of the operators: tables, scratch folder, document keys, word splitting."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space between words in every contract: space and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"
#: Columns that identify a document inside an operator: 128 bits over doc_id and text.
KEY = ("_doc_a", "_doc_b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """The folder that all executors share. A session without one (tests) gets a local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="textlens-"))
    return context._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there, its rows are fixed."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: unlike a written table it also keeps partitions and their order."""
    scratch_folder(df.sparkSession)
    return df.checkpoint()


def with_key(docs: DataFrame) -> DataFrame:
    """Add the document key. Rows with the same doc_id and text are one document; nulls differ from all values."""
    parts = [F.col("doc_id").cast("string"), F.col("doc_id").isNull(), F.col("text"), F.col("text").isNull()]
    return docs.withColumns({KEY[0]: F.xxhash64(*parts), KEY[1]: F.xxhash64(F.lit(1), *parts)})


def hash128(*columns: Column) -> list[Column]:
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def partitions_for(total: int, each: int, least: int = 1) -> int:
    return max(least, -(-int(total) // each))


def flat_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space of each text, one after the other, and the number of each text's words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, counts = lists.flatten(), np.diff(lists.offsets.to_numpy())
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        owner = np.repeat(np.arange(len(texts)), counts)[full]
        counts = np.bincount(owner, minlength=len(texts))
        flat = flat.filter(pa.array(full))
    return flat, counts.astype(np.int64)


def word_codes(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each word in the list of distinct words, and that list."""
    if len(flat) == 0:
        return np.zeros(0, np.int64), flat
    encoded = flat.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Where each of consecutive runs begins, and at the end the total."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + counts[i] - 1 of all runs, one run after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return shift + np.arange(total, dtype=np.int64)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int):
    """Parts of a batch that hold about most_bytes of a text column each (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift, for uint64 arrays."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def string_hashes(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each string."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in distinct.cast(pa.binary()).to_pylist()), np.uint64, len(distinct))
