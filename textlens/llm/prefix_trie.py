"""A trie of conversation prefixes: sorted shards finish their own nodes, a skeleton of splitter paths joins them."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.llm.shared import partitions_for, stored

#: Bytes of a turn's mark in a path: the first half of a SHA-256.
MARK = 16
#: Bytes of paths in a shard, about; a turn takes 16.
SHARD_BYTES = 8 << 20
#: Bytes of paths that the driver gets to choose splitters from, about. The skeleton has a node for each 16 of them at most.
SPLITTER_BYTES = 8 << 20
#: Longer paths are no splitters.
LONGEST_SPLITTER = 64 << 10
#: Ids in a piece of the list of a skeleton node's ends.
ENDS_IN_PIECE = 1500
NO_ENDS = hashlib.sha256().hexdigest()
TRIE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _blank(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def turn_lists(conversations: DataFrame, group: Column) -> DataFrame:
    """(bucket, conv_id, turns): each conversation's turns as (turn, mark, words), placed by `group`.

    Turns are ordered by number, null first, and those of one number by their mark, the SHA-256 of role and text. Null
    role and text are empty. Rows without conv_id belong to no conversation and are left out; repeated rows are
    repeated turns.
    """
    content = F.concat(F.length(_blank("role")).cast("string"), F.lit(":"), _blank("role"), _blank("text"))
    mark = F.substring(F.sha2(content, 256), 1, 2 * MARK)
    words = F.regexp_count(_blank("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = conversations.filter("conv_id IS NOT NULL").select(group.cast("long").alias("bucket"), F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), mark.alias("mark"), words.alias("words")).alias("turn"))
    # Only marks and counts move, once: conversations of a bucket meet in a task.
    return rows.repartition("bucket").groupBy("bucket", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def paths_of(lists: DataFrame, turns: Column) -> DataFrame:
    """(conv_id, path, words): marks of the turns as bytes, 16 each, and the words of each."""
    return lists.select("conv_id", F.unhex(F.array_join(F.transform(turns, lambda t: t["mark"]), "")).alias("path"), F.transform(turns, lambda t: t["words"]).alias("words"))


def with_borrowed_starts(conversations: DataFrame, block: int = 20, most: int = 3) -> DataFrame:
    """Paths of rebuilt conversations: c starts with the first h turns of conversation c - c % block, then come its own
    turns after the first h, where h is the crc32 of the decimal c modulo most + 1. A missing one lends nothing."""
    first = F.col("conv_id") - F.col("conv_id") % block
    lists = turn_lists(conversations, first)
    lender = F.first(F.when(F.col("conv_id") == F.col("bucket"), F.slice("turns", 1, most)), ignorenulls=True)
    lists = lists.withColumn("lent", lender.over(Window.partitionBy("bucket")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    lent = F.coalesce(F.slice("lent", F.lit(1), h), F.slice("turns", 1, 0))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return paths_of(lists, F.concat(lent, own))


def common_turns(a: bytes, b: bytes) -> int:
    """Marks that two paths have in common at their start."""
    high = min(len(a), len(b)) // MARK
    if a[: high * MARK] == b[: high * MARK]:
        return high
    low = 0
    while high - low > 1:
        middle = (low + high) // 2
        if a[: middle * MARK] == b[: middle * MARK]:
            low = middle
        else:
            high = middle
    return low


class Skeleton:
    """The trie of the splitter paths. Nodes are numbered in preorder, the root is 0."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.parent, self.depth = [-1], [0]
        self.nodes: list[list[int]] = []  # of each splitter's prefixes
        before, line = b"", [0]
        for path, _ in splitters:
            line = line[: common_turns(before, path) + 1]
            for _ in range(len(line), len(path) // MARK + 1):
                self.parent.append(line[-1])
                self.depth.append(len(line))
                line.append(len(self.parent) - 1)
            self.nodes.append(line)
            before = path

    def shard(self, path: bytes, conv: int) -> int:
        return bisect.bisect_right(self.splitters, (path, conv))

    def spine(self, shard: int, path: bytes) -> list[int]:
        """Skeleton nodes on the path of a row of a shard. Others have all their rows in the shard: rows on both sides
        of a splitter can only share a prefix of it."""
        best = [0]
        for k in (shard - 1, shard):
            if 0 <= k < len(self.splitters):
                n = common_turns(path, self.splitters[k][0])
                if n + 1 > len(best):
                    best = self.nodes[k][: n + 1]
        return best


class Shard:
    """Sorted paths of one shard, and the part of the trie that they make. Node 0 is the root."""

    def __init__(self, number: int, skeleton: Skeleton):
        self.number, self.skeleton = number, skeleton
        self.parent, self.depth, self.weight, self.spine = [-1], [0], [0], [0]
        self.n, self.least = [0], [None]
        self.ends: list[list[int]] = [[]]
        self.line, self.before, self.near = [0], b"", [0]

    def add(self, conv: int, path: bytes, words: list[int]) -> None:
        if path != self.before:
            self.near = self.skeleton.spine(self.number, path)
            del self.line[common_turns(self.before, path) + 1 :]
            for d in range(len(self.line), len(path) // MARK + 1):
                self.parent.append(self.line[-1])
                self.depth.append(d)
                self.weight.append(words[d - 1])
                self.spine.append(self.near[d] if d < len(self.near) else -1)
                self.n.append(0)
                self.least.append(None)
                self.ends.append([])
                self.line.append(len(self.parent) - 1)
            self.before = path
        top = self.line[-1]
        self.n[top] += 1
        self.least[top] = conv if self.least[top] is None else min(conv, self.least[top])
        self.ends[top].append(conv)

    def finish(self) -> None:
        """Sum up towards the root: members of all nodes, and what hangs below them for the shard's own."""
        size = len(self.parent)
        self.children, self.leaves, self.saved = [0] * size, [0] * size, [0] * size
        for v in range(size - 1, 0, -1):
            p = self.parent[v]
            self.n[p] += self.n[v]
            self.least[p] = self.least[v] if self.least[p] is None else min(self.least[p], self.least[v])
            if self.spine[v] < 0:
                self.children[p] += 1
                self.leaves[p] += self.leaves[v] or 1
                self.saved[v] += (self.n[v] - 1) * self.weight[v]
                self.saved[p] += self.saved[v]


ROWS = pa.schema(
    [(c, pa.int64()) for c in ("node", "conv_id", "depth", "parent", "parent_conv_id", "n", "children", "leaves", "saved", "weight", "shard", "place")] + [("ends", pa.string())]
)
ROWS_SQL = ", ".join(f"{f.name} {'string' if f.name == 'ends' else 'long'}" for f in ROWS)


def _rows(part: Shard) -> Iterator[pa.RecordBatch]:
    """Finished nodes (node null, parent: the skeleton's node or null), sums of skeleton nodes (place null) and pieces
    of their ends."""
    part.finish()
    out: list[dict] = []
    for v in range(len(part.parent)):
        shared = part.spine[v] >= 0
        row = {"conv_id": part.least[v], "depth": part.depth[v], "n": part.n[v], "children": part.children[v], "leaves": part.leaves[v], "saved": part.saved[v]}
        if shared:
            out.append(row | {"node": part.spine[v], "weight": part.weight[v]})
            ids = part.ends[v]
            for k in range(0, len(ids), ENDS_IN_PIECE):
                out.append({"node": part.spine[v], "shard": part.number, "place": k, "ends": ",".join(map(str, ids[k : k + ENDS_IN_PIECE]))})
        else:
            p = part.parent[v]
            above = {"parent": part.spine[p]} if part.spine[p] >= 0 else {"parent_conv_id": part.least[p]}
            ends = hashlib.sha256(",".join(map(str, part.ends[v])).encode()).hexdigest() if part.ends[v] else NO_ENDS
            out.append(row | above | {"leaves": part.leaves[v] or 1, "ends": ends})
        if len(out) >= 20_000:
            yield pa.RecordBatch.from_pylist(out, schema=ROWS)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=ROWS)


def _hashed_ends(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256): pieces in order run through one hash, so that no list is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, first = None, hashlib.sha256(), True
        done: list[tuple[int, str]] = []
        for batch in batches:
            for k, text in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if k != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state, first = k, hashlib.sha256(), True
                state.update(("" if first else ",").encode() + text.encode())
                first = False
        if node is not None:
            done.append((node, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())], names=["node", "ends_sha256"])

    ordered = pieces.select("node", "shard", "place", "ends").repartition("node").sortWithinPartitions("node", "shard", "place")
    return ordered.mapInArrow(run, "node long, ends_sha256 string")


def _splitters(paths: DataFrame, shards: int, total: int) -> list[tuple[bytes, int]]:
    """Up to shards - 1 rows (path, conv_id) at equal distances in the order of a sample by hash."""
    share = min(1.0, SPLITTER_BYTES / max(1, total))
    drawn = F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    some = sorted((bytes(r["path"]), r["conv_id"]) for r in paths.filter(drawn & (F.length("path") <= LONGEST_SPLITTER)).select("path", "conv_id").collect())
    return sorted({some[len(some) * k // shards] for k in range(1, shards)}) if some else []


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of `paths` (conv_id, path of 16-byte marks, words of each turn).

    A node is a distinct sequence of first turns, the root the empty one. Columns: conv_id (least member; with depth it
    names the node), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (childless nodes
    of its subtree, itself included), saved_tokens (over its subtree: members but one, times words of the last turn),
    ends_sha256 (of the ids that end there, ascending, joined by commas). conv_id is unique and not null. An empty table
    has no nodes. A path is one row, 20 bytes a turn; beyond that no node's members come together.

    Paths are dealt to shards of about 8 MB by splitters, which are rows (path, conv_id) themselves: so copies of a
    path, however many, cover several shards. Rows on both sides of a splitter share prefixes of that splitter only, so
    the trie of all splitter paths, which is broadcast (up to about 8 MB of paths), holds every node with rows in more
    than one shard. Sorted shards finish all other nodes; for skeleton nodes they send sums, which are reduced by node,
    and pieces of the list of ends, which run through the hash in order.
    """
    spark = paths.sparkSession
    paths = stored(paths)
    total = paths.agg(F.count("*").alias("n"), F.sum(F.length("path")).alias("bytes")).head()
    if shards is None:
        shards = min(max(1, total["n"]), partitions_for(total["bytes"] or 0, SHARD_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    skeleton = Skeleton(_splitters(paths, shards, total["bytes"] or 0))
    sent = spark.sparkContext.broadcast(skeleton)

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv: pd.Series) -> pd.Series:
        return pd.Series([sent.value.shard(p, c) for p, c in zip(path, conv, strict=True)], dtype="int32")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            for number, conv, path, words in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "words")), strict=True):
                if part is None or part.number != number:
                    if part is not None:
                        yield from _rows(part)
                    part = Shard(number, sent.value)
                part.add(conv, path, words)
        if part is not None:
            yield from _rows(part)

    dealt = paths.withColumn("shard", shard_of("path", "conv_id")).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    rows = stored(dealt.select("shard", "conv_id", "path", "words").mapInArrow(walk, ROWS_SQL))
    shared = _skeleton_nodes(rows.filter("node IS NOT NULL AND place IS NULL"), skeleton)
    own = rows.filter("node IS NULL").join(F.broadcast(shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))), "parent", "left")
    own = own.select("conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
    hashed = _hashed_ends(rows.filter("place IS NOT NULL"))
    top = shared.join(hashed, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    return own.unionByName(top.select(own.columns))


def _skeleton_nodes(sums: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Skeleton nodes: the shards' sums reduced by node on the cluster, then along the skeleton from its leaves up. The
    latter is a loop over the skeleton, which is bounded by SPLITTER_BYTES, not over conversations."""
    reduced = sums.groupBy("node").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")), F.max("weight").alias("weight"))
    got = {r["node"]: r for r in reduced.collect()}
    size = len(skeleton.parent) if got else 0
    children, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    rows = []
    for v in range(size - 1, -1, -1):
        r, p = got[v], skeleton.parent[v]
        children[v] += r["children"]
        leaves[v] += r["leaves"] + (children[v] == 0)
        saved[v] += r["saved"] + (r["n"] - 1) * r["weight"]
        if p >= 0:
            children[p] += 1
            leaves[p] += leaves[v]
            saved[p] += saved[v]
        rows.append((v, r["conv_id"], skeleton.depth[v], got[p]["conv_id"] if p >= 0 else None, r["n"], int(children[v]), int(leaves[v]), int(saved[v])))
    return sums.sparkSession.createDataFrame(rows, "node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
