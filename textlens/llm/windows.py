"""Repeated windows of a corpus: the exchange that substring operators share.

A window is a fixed number of consecutive symbols (bytes or words) of one document. Its anchor is the run of fewer
symbols inside it that has the least hash, so equal windows have equal anchors. Neighbouring windows with the same
anchor form a segment. The exchange goes:

1. Documents are written once, packed into blocks of about 2 MB.
2. Blocks send hashes of their distinct anchors; an anchor is shared if it occurs in two places that count.
3. Blocks send their distinct segments with shared anchors to the anchor's shard. There an index of the segments tells
   which windows repeat. Windows of anchors that are in thousands of places travel alone, by a hash of their content,
   so no shard holds all contexts of a frequent passage.
4. Shards answer per block and segment; blocks mark what their documents lose.

Windows whose anchor is not shared can't repeat, so nothing is lost on the way, and equal windows always meet in one
shard.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.shared import mix, partitions_for, ranges, slices, starts_of, stored

#: Text bytes of a block; text bytes for which there is one shard; places from which on an anchor is frequent.
BLOCK_BYTES, SHARD_BYTES, FREQUENT = 2 << 20, 4 << 20, 4096
#: What goes back to blocks is a broadcast up to so many bytes, and beyond that a shuffle join.
BROADCAST_BYTES = 64 << 20
#: Blocks that a task of that join gets, on average.
TASK_BLOCKS = 8
NO_ID = np.iinfo(np.int64).max

#: (segments as one array, their starts, value of each segment) -> value of each window, segment after segment.
Solver = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Windows:
    """Windows of `size` symbols with anchors of `anchor` symbols.

    `across` counts an anchor or segment by its documents' ids, else by its places. The solver gets for each segment
    the least id, or the number of places, and gives for each window the least id or the number of places of all
    windows equal to it.
    """

    size: int
    anchor: int
    words: bool
    across: bool
    solve: Solver


@dataclass
class Block:
    """Symbols of a block's documents. For words, a symbol is the hash of a word, whose place in the data is kept."""

    ids: np.ndarray
    data: np.ndarray
    symbols: np.ndarray
    starts: np.ndarray
    words: tuple[np.ndarray, np.ndarray] | None
    hashes: RunHashes

    @staticmethod
    def of(row: dict, scheme: Windows) -> Block:
        ids = row["ids"].values.to_numpy(zero_copy_only=False)
        data, ends = np.frombuffer(row["data"].as_buffer(), np.uint8), row["ends"].values.to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], ends]).astype(np.int64)
        letters = RunHashes(BYTES[data])
        if not scheme.words:
            return Block(ids, data, data, bounds, None, letters)
        inner = ~BLANK[data]
        first, last = inner.copy(), inner.copy()
        first[1:] &= ~inner[:-1]
        last[:-1] &= ~inner[1:]
        edge = bounds[:-1][bounds[:-1] < len(data)]
        first[edge] = inner[edge]
        edge = bounds[1:][bounds[1:] > 0] - 1
        last[edge] = inner[edge]
        start = np.flatnonzero(first)
        length = np.flatnonzero(last) + 1 - start
        symbols = mix(letters.of(start, length) ^ length.astype(np.uint64), 9)
        return Block(ids, data, symbols, np.searchsorted(start, bounds), (start, length), RunHashes(symbols))


def blocks_of(docs: DataFrame) -> DataFrame:
    """Documents packed into blocks (block, ids, raw, data, ends), written to the shared folder. `raw` are the doc_ids; `ids`
    have their order, moved down by one, so that NO_ID is left for null, which comes last of all. (Only the two least
    64-bit numbers count as one.)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                texts = part.column("text").fill_null("").cast(pa.binary()).to_pylist()
                ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
                raw = part.column("doc_id")
                ids = raw.fill_null(0).to_numpy()
                ids = np.where(raw.is_null().to_numpy(zero_copy_only=False), NO_ID, ids - (ids > np.iinfo(np.int64).min))
                yield pa.RecordBatch.from_pydict({"ids": [ids], "raw": [raw.to_pylist()], "data": [b"".join(texts)], "ends": [ends]}, schema=BLOCK)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(run, "ids array<long>, raw array<long>, data binary, ends array<long>").withColumn("block", F.monotonically_increasing_id()))


BLOCK = pa.schema([("ids", pa.list_(pa.int64())), ("raw", pa.list_(pa.int64())), ("data", pa.binary()), ("ends", pa.list_(pa.int64()))])


#: An odd base and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Symbols of a run that are hashed as one polynomial.
PART = 256
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """The first powers of a base modulo 2^64; the longest list so far is kept."""
    if base not in _powers or len(_powers[base]) < count:
        factors = np.full(max(count, 1 << 16), base, np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors)
    return _powers[base][:count]


class RunHashes:
    """Hashes of any runs of a sequence of 64-bit values, from prefix sums of value times power."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(BASE, self.n))])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Long runs are hashed in parts, and the mixed hashes of the parts are added up: modulo 2^64 some long runs, the
        Thue-Morse strings from 1,024 symbols on, have equal sums whatever the base."""
        length = np.broadcast_to(length, np.shape(start))
        out = self._short(start, np.minimum(length, PART))
        long = np.flatnonzero(length > PART)
        if len(long):
            parts = -(-length[long] // PART)
            offset = PART * ranges(np.zeros(len(long), np.int64), parts)
            begin = np.repeat(start[long], parts) + offset
            mixed = mix(self._short(begin, np.minimum(PART, np.repeat(length[long], parts) - offset)) ^ mix(offset.astype(np.uint64), 3), 4)
            out[long] = np.add.reduceat(mixed, np.cumsum(parts) - parts)
        return out

    def _short(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * powers(INVERSE, self.n + 1)[start]

    def all(self, length: int) -> np.ndarray:
        """Of every run of one length."""
        count = max(0, self.n - length + 1)
        return (self.sums[length : length + count] - self.sums[:count]) * powers(INVERSE, count)


#: A random value for each byte, and which bytes are white space.
BYTES = mix(np.arange(256, dtype=np.uint64), 77)
BLANK = np.isin(np.arange(256), [32, *range(9, 14)])


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values, by overlapping powers of two."""
    if len(values) < width:
        return values[:0]
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if width > done else values


@dataclass
class Segments:
    """Segments of a block, in order of position: hash of the anchor, first window, number of windows, document."""

    anchors: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    doc: np.ndarray


def segments_of(block: Block, scheme: Windows) -> Segments:
    counts = np.maximum(0, np.diff(block.starts) - scheme.size + 1)
    if not counts.sum():
        none = np.zeros(0, np.int64)
        return Segments(np.zeros(0, np.uint64), none, none, none)
    hashes = block.hashes.all(scheme.anchor)
    order = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    at = (least_of(order, scheme.size - scheme.anchor + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    window = ranges(block.starts[:-1], counts)
    at = at[window]
    doc = np.repeat(np.arange(len(counts)), counts)
    fresh = np.ones(len(window), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    begins = np.flatnonzero(fresh)
    return Segments(mix(hashes[at[begins]], 3), window[begins], np.diff(np.append(begins, len(window))), doc[begins])


def give_back() -> None:
    """Freed memory goes back to the system: a worker that has solved a shard stays, beside what later stages need."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes, so hashes in order are in order of shard, too."""
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


@dataclass
class Anchors:
    """Distinct anchors of a block in order of hash, with the places of each; `of` numbers them for each segment."""

    hashes: np.ndarray
    shards: np.ndarray
    of: np.ndarray
    places: np.ndarray

    @staticmethod
    def of_segments(segments: Segments, shards: int, across: bool) -> Anchors:
        order = np.argsort(segments.anchors, kind="stable")
        anchor, doc = segments.anchors[order], segments.doc[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = anchor[1:] != anchor[:-1]
        number = np.empty(len(order), np.int64)
        number[order] = group = np.cumsum(fresh) - 1
        distinct = anchor[fresh]
        if across:  # documents, not places: the sort keeps them together
            fresh[1:] |= doc[1:] != doc[:-1]
            group = group[fresh]
        return Anchors(distinct, shard_of(distinct, shards), number, np.bincount(group, minlength=len(distinct)))


def _anchor_rows(scheme: Windows, shards: int):
    """Of each block: for each shard the low halves of its anchors' hashes (the shard stands for the rest) and places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in _blocks(batches, scheme):
            anchors = Anchors.of_segments(segments_of(block, scheme), shards, scheme.across)
            if not len(anchors.hashes):
                continue
            cut = np.flatnonzero(np.diff(anchors.shards, prepend=-1))
            ends = np.append(cut[1:], len(anchors.shards))
            low = (anchors.hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            many = np.minimum(anchors.places, 255).astype(np.uint8)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(anchors.shards[cut], pa.int64()),
                    "block": pa.array([row["block"].as_py()] * len(cut), pa.int64()),
                    "low": pa.array([low[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()),
                    "places": pa.array([many[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()),
                }
            )

    return run


def _blocks(batches: Iterator[pa.RecordBatch], scheme: Windows) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            yield row, Block.of(row, scheme)
        give_back()


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """One shard: which anchors of each block are shared, and which are frequent."""
    low = [np.frombuffer(x, np.uint32) for x in frame["low"]]
    sizes = np.array([len(x) for x in low])
    distinct, number = np.unique(np.concatenate(low), return_inverse=True)
    places = np.concatenate([np.frombuffer(x, np.uint8) for x in frame["places"]])
    total = np.bincount(number, weights=places, minlength=len(distinct))[number]
    ends = np.cumsum(sizes)
    bits = [[np.packbits(total[e - n : e] >= least).tobytes() for n, e in zip(sizes, ends, strict=True)] for least in (2, FREQUENT)]
    return pd.DataFrame({"block": frame["block"], "shard": frame["shard"], "shared": bits[0], "frequent": bits[1]})


def _with_answers(blocks: DataFrame, answers: DataFrame, columns: list[str]) -> DataFrame:
    """Blocks with what shards sent them, as an array of structs. Beyond the limit blocks move, too, and meet a hash table of
    the answers, so that no text is sorted; each task gets a few blocks, however many the session's shuffles would give it."""
    per = stored(answers.groupBy("block").agg(F.collect_list(F.struct("shard", *columns)).alias("answers")))
    size = per.select(F.sum(F.aggregate("answers", F.lit(0).cast("long"), lambda acc, x: acc + sum((F.octet_length(x[c]) for c in columns), F.lit(64))))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return blocks.join(F.broadcast(per), "block", "left")
    tasks = partitions_for(blocks.count(), TASK_BLOCKS, blocks.sparkSession.sparkContext.defaultParallelism)
    return blocks.repartition(tasks, "block").join(per.repartition(tasks, "block").hint("shuffle_hash"), "block", "left")


@dataclass
class Chosen:
    """Segments that a block sends, distinct by content in each shard, and the places of each."""

    shard: np.ndarray  # of each distinct segment, ascending
    start: np.ndarray  # a place of it
    length: np.ndarray
    of: np.ndarray  # number of the distinct segment at each place
    place: np.ndarray  # first symbol of each place
    doc: np.ndarray


def _flags(row: dict, anchors: Anchors) -> tuple[np.ndarray, np.ndarray]:
    shared, frequent = np.zeros(len(anchors.hashes), bool), np.zeros(len(anchors.hashes), bool)
    for answer in row["bits"].as_py() or ():
        a, b = np.searchsorted(anchors.shards, [answer["shard"], answer["shard"] + 1])
        for name, flags in (("shared", shared), ("frequent", frequent)):
            flags[a:b] = np.unpackbits(np.frombuffer(answer[name], np.uint8), count=b - a)
    return shared, frequent


def chosen_segments(row: dict, block: Block, scheme: Windows, shards: int) -> Chosen:
    segments = segments_of(block, scheme)
    anchors = Anchors.of_segments(segments, shards, scheme.across)
    shared, frequent = _flags(row, anchors)
    own, alone = shared[anchors.of] & ~frequent[anchors.of], frequent[anchors.of]
    # Windows of frequent anchors are segments of their own.
    single = ranges(segments.first[alone], segments.windows[alone])
    place = np.concatenate([segments.first[own], single])
    count = np.concatenate([segments.windows[own], np.ones(len(single), np.int64)])
    doc = np.concatenate([segments.doc[own], np.repeat(segments.doc[alone], segments.windows[alone])])
    if not len(place):
        none = np.zeros(0, np.int64)
        return Chosen(none, none, none, none, none, none)
    between = mix(block.hashes.of(place, count + scheme.size - 1), 5)
    by_anchor = np.concatenate([segments.anchors[own], between[own.sum() :]])
    shard = shard_of(by_anchor, shards)
    order = np.lexsort((between, shard))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (shard[order][1:] != shard[order][:-1]) | (between[order][1:] != between[order][:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    lead = order[fresh]
    return Chosen(shard[lead], place[lead], count[lead] + scheme.size - 1, number, place, doc)


def _segment_rows(scheme: Windows, shards: int):
    """Of each block and shard: its distinct segments, one after the other, and each one's least id or places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in _blocks(batches, scheme):
            chosen = chosen_segments(row, block, scheme, shards)
            n = len(chosen.shard)
            if not n:
                continue
            if scheme.across:
                value, most = np.full(n, NO_ID), np.full(n, np.iinfo(np.int64).min)
                np.minimum.at(value, chosen.of, block.ids[chosen.doc])
                np.maximum.at(most, chosen.of, block.ids[chosen.doc])
            else:
                value = most = np.bincount(chosen.of, minlength=n)
            cut = np.flatnonzero(np.diff(chosen.shard, prepend=-1)).tolist()
            out = {"shard": chosen.shard[cut], "block": [row["block"].as_py()] * len(cut), "symbols": [], "lengths": [], "value": [], "most": []}
            for a, b in zip(cut, [*cut[1:], n], strict=True):
                out["symbols"].append(block.symbols[ranges(chosen.start[a:b], chosen.length[a:b])].tobytes())
                out["lengths"].append(chosen.length[a:b].astype(np.int32).tobytes())
                out["value"].append(value[a:b].astype(np.int64).tobytes())
                out["most"].append(most[a:b].astype(np.int64).tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=SEGMENTS)

    return run


SEGMENTS = pa.schema([("shard", pa.int64()), ("block", pa.int64()), *((x, pa.binary()) for x in ("symbols", "lengths", "value", "most"))])


def _solved(scheme: Windows):
    """One shard: merge equal segments of all blocks, solve, and tell each block the runs of windows that repeat."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        kind = np.uint64 if scheme.words else np.uint8
        symbols = np.concatenate([np.frombuffer(x, kind) for x in frame["symbols"]])
        lengths, value, most = (np.concatenate([np.frombuffer(x, t) for x in frame[c]]).astype(np.int64) for c, t in (("lengths", np.int32), ("value", np.int64), ("most", np.int64)))
        sizes = np.array([len(x) // 4 for x in frame["lengths"]])
        owner = np.repeat(np.arange(len(frame)), sizes)
        starts = np.cumsum(lengths) - lengths
        width = symbols.itemsize
        raw = symbols.tobytes()
        numbers: dict[bytes, int] = {}
        of = np.array([numbers.setdefault(raw[a * width : b * width], len(numbers)) for a, b in zip(starts.tolist(), (starts + lengths).tolist(), strict=True)])
        lead = np.unique(of, return_index=True)[1]
        if scheme.across:
            merged = np.full(len(lead), NO_ID)
            np.minimum.at(merged, of, value)
        else:
            merged = np.bincount(of, weights=value).astype(np.int64)
        distinct = symbols[ranges(starts[lead], lengths[lead])]
        windows = lengths[lead] - scheme.size + 1
        answer = scheme.solve(distinct, starts_of(lengths[lead]), merged)
        del distinct, raw, numbers
        # Runs of equal answers inside each distinct segment.
        segment = np.repeat(np.arange(len(lead)), windows)
        inside = np.arange(len(answer)) - np.repeat(np.cumsum(windows) - windows, windows)
        fresh = np.ones(len(answer), bool)
        fresh[1:] = (answer[1:] != answer[:-1]) | (segment[1:] != segment[:-1])
        begins = np.flatnonzero(fresh)
        run_of, run_first, run_count, run_value = segment[begins], inside[begins], np.diff(np.append(begins, len(answer))), answer[begins]
        run_start = np.searchsorted(run_of, np.arange(len(lead) + 1))
        n = np.diff(run_start)[of]
        item = np.repeat(np.arange(len(of)), n)
        pick = ranges(run_start[of], n)
        counts = run_value[pick] < most[item] if scheme.across else run_value[pick] >= 2
        item, pick = item[counts], pick[counts]
        number = item - (np.cumsum(sizes) - sizes)[owner[item]]
        table = np.stack([number, run_first[pick], run_count[pick], run_value[pick]]).astype(np.int64)
        ends = np.searchsorted(owner[item], np.arange(len(frame) + 1))
        packed = [zlib.compress(table[:, a:b].tobytes(), 1) if b > a else b"" for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pd.DataFrame({"block": frame["block"], "shard": frame["shard"], "runs": packed})

    def run_and_give_back(frame: pd.DataFrame) -> pd.DataFrame:
        out = run(frame)
        give_back()
        return out

    return run_and_give_back


def _removed(row: dict, block: Block, scheme: Windows, shards: int) -> np.ndarray:
    """Which symbols of a block lie in windows that repeat."""
    edge = np.zeros(len(block.symbols) + 1, np.int64)
    answers = row["runs"].as_py()
    if answers:
        chosen = chosen_segments(row, block, scheme, shards)
        tables = []
        for answer in answers:
            table = np.frombuffer(zlib.decompress(answer["runs"]), np.int64).reshape(4, -1).T.copy()
            table[:, 0] += np.searchsorted(chosen.shard, answer["shard"])
            tables.append(table)
        table = np.concatenate(tables)
        table = table[np.argsort(table[:, 0], kind="stable")]
        bounds = np.searchsorted(table[:, 0], np.arange(len(chosen.shard) + 1))
        n = np.diff(bounds)[chosen.of]
        place = np.repeat(np.arange(len(chosen.of)), n)
        run = table[ranges(bounds[:-1][chosen.of], n)]
        if scheme.across:
            later = run[:, 3] < block.ids[chosen.doc[place]]
            place, run = place[later], run[later]
        start = chosen.place[place] + run[:, 1]
        edge = np.bincount(start, minlength=len(edge)) - np.bincount(start + run[:, 2] + scheme.size - 1, minlength=len(edge))
    return np.cumsum(edge)[:-1] > 0


def _kept(block: Block, removed: np.ndarray) -> pa.Array:
    """What is left of each document: bytes, or words joined by a space."""
    keep = ~removed
    ends = starts_of(keep)[block.starts]
    if block.words is None:
        data = block.symbols[keep].tobytes()
        return pa.array([data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
    # Each kept word with one byte more, which becomes the space after it.
    start, length = block.words[0][keep], block.words[1][keep] + 1
    at = ranges(start, length)
    data = block.data[np.minimum(at, len(block.data) - 1)] if len(at) else np.zeros(0, np.uint8)
    after = starts_of(length)
    data[after[1:] - 1] = 32
    raw, cuts = data.tobytes(), after[ends].tolist()
    return pa.array([raw[a : max(a, b - 1)] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())


def _results(scheme: Windows, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in _blocks(batches, scheme):
            removed = _removed(row, block, scheme, shards)
            sums = starts_of(removed)[block.starts]
            begins = removed.copy()
            inner = np.ones(len(removed), bool)
            inner[block.starts[:-1][block.starts[:-1] < len(removed)]] = False
            begins[1:] &= ~(removed[:-1] & inner[1:])
            spans = starts_of(begins)[block.starts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": row["raw"].values,
                    "n_symbols": pa.array(np.diff(block.starts)),
                    "n_removed": pa.array(np.diff(sums)),
                    "n_spans": pa.array(np.diff(spans)),
                    "kept": _kept(block, removed),
                }
            )

    return run


def without_repeated_windows(docs: DataFrame, scheme: Windows) -> DataFrame:
    """A row for each document: doc_id, n_symbols, n_removed, n_spans (maximal removed runs), kept (UTF-8 bytes).

    `docs` needs doc_id, an integer, and text; a null text is empty. With `across`, a null doc_id counts as larger than
    every other, and rows with the same doc_id as one document.
    """
    blocks = blocks_of(docs)
    total = blocks.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    shards = partitions_for(total, SHARD_BYTES, 1)
    sent = blocks.mapInArrow(_anchor_rows(scheme, shards), "shard long, block long, low binary, places binary")
    bits = sent.groupBy("shard").applyInPandas(_shared, "block long, shard long, shared binary, frequent binary")
    marked = _with_answers(blocks, bits, ["shared", "frequent"]).withColumnRenamed("answers", "bits")
    segments = marked.mapInArrow(_segment_rows(scheme, shards), "shard long, block long, symbols binary, lengths binary, value binary, most binary")
    runs = segments.groupBy("shard").applyInPandas(_solved(scheme), "block long, shard long, runs binary")
    answered = _with_answers(marked, runs.filter(F.octet_length("runs") > 0), ["runs"]).withColumnRenamed("answers", "runs")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = answered.mapInArrow(_results(scheme, shards), "doc_id long, n_symbols long, n_removed long, n_spans long, kept binary")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))
