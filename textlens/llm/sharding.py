"""Contiguous shards of nearly equal bytes by prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.llm.shared import checkpointed, stored


def contiguous_shards(rows: DataFrame, size: Column, order: list[Column], shards: int, partitions: int | None = None) -> DataFrame:
    """Put rows, in the given order, into shards whose sizes are nearly equal.

    Adds `shard` (from 0) and `slot` (place in the shard, from 0, gapless) to the columns of `rows`. Rows are
    range-partitioned by `order`; partitions report their totals, whose prefix sums give each row the bytes before
    it. A row goes to the shard that holds the middle of its bytes, so a shard misses its target by half a row at
    each end. Equal rows are told apart by their place in the scan, so a key with many rows is spread over
    partitions. Sizes must be positive; an empty table gives an empty result.
    """
    rows = stored(rows.withColumns({"_size": size.cast("long"), "_place": F.monotonically_increasing_id()}))
    wanted = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col("_place")]
    ranged = rows.repartitionByRange(wanted, *keys).sortWithinPartitions(*keys)
    ranged = checkpointed(ranged.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    # One row for each partition: the window below orders these totals, never the rows.
    totals = ranged.groupBy("_part").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("_part"),
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )
    inside = Window.partitionBy("_part").orderBy("_row")
    placed = (
        ranged.withColumns({"_end": F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "_nth": F.row_number().over(inside)})
        .join(totals, "_part")
        .withColumn("_twice", 2 * (F.col("_bytes_before") + F.col("_end")) - F.col("_size"))
        .withColumn("shard", F.least(F.floor(F.col("_twice") * shards / (2 * F.col("_all"))), F.lit(shards - 1)).cast("int"))
        .withColumn("_number", F.col("_rows_before") + F.col("_nth") - 1)
    )
    first = placed.groupBy("shard").agg(F.min("_number").alias("_first"))  # one row for each shard
    joined = placed.join(F.broadcast(first), "shard")
    return joined.select(*[joined[c] for c in rows.columns if c not in ("_size", "_place")], "shard", (F.col("_number") - F.col("_first")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shards of documents by bytes, in order of doc_id: doc_id, size, text_crc32, shard, slot.

    A document's size is its UTF-8 bytes plus 8; a null text has no bytes and the checksum of an empty one. Null
    ids come first; repeated rows are placed one by one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return contiguous_shards(rows, F.col("size"), [F.col("doc_id"), F.col("text_crc32")], shards)
