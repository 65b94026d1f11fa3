"""Packing of token pieces into sequences: best fit, then local search by moves and exchanges."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.shared import flat_words, partitions_for, ranges, slices, starts_of, stored, word_codes

#: Text bytes tokenized at a time; pieces packed by one task.
BATCH_BYTES, GROUP_PIECES = 4 << 20, 4096
#: Sequences filled less than this share are packed once more, together with those of other groups.
FULL_ENOUGH = 0.98


class PartEncoder:
    """Token ids of strings without white space. Distinct words are encoded once as long as they are remembered.

    Parts of plain Latin letters, digits and signs are lowered and cut into the tokenizer's own words by Arrow kernels, a
    batch at a time, and only new words go to the library, without its normaliser and splitter, which would leave them
    as they are. All other parts, and those that may hold a special token, go through the whole tokenizer, each as a
    word of its own. A tokenizer with other rules always does all.
    """

    #: The rules for which the short way is the same (fixed values of the file format).
    LOWER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

    #: Signs, digits and letters of which the library's rules change nothing but the case, and words of them.
    PLAIN = "^[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
    WORD = "('s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9]+)"

    def __init__(self, model: str, remembered: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(model)
        rules = json.loads(model)
        split = [x.get("pattern", {}).get("Regex") for x in (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.short = (rules.get("normalizer") or {}).get("normalizers") == self.LOWER and split == [self.WORDS, None]
        rules["normalizer"], rules["pre_tokenizer"] = None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
        self.words = Tokenizer.from_str(json.dumps(rules)) if self.short else self.whole
        self.remembered = remembered
        self.forget()

    def forget(self) -> None:
        """Start with no known words and parts."""
        self.word_slot: dict[str, int] = {}
        self.part_slot: dict[str, int] = {}
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _slots(self, strings: list[str], tokenizer, slot: dict[str, int]) -> np.ndarray:
        """Places of the strings' ids among all that are known; new strings are encoded first."""
        new = [x for x in strings if x not in slot]
        if new:
            found = [x.ids for x in tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            slot.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new)), strict=True))
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, found), np.int64, len(found))])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32)])
        return np.fromiter(map(slot.__getitem__, strings), np.int64, len(strings))

    def encode(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, one after the other, and their numbers."""
        if len(self.word_slot) + len(self.part_slot) > self.remembered:
            self.forget()
        plain = np.zeros(len(parts), bool)
        if self.short and len(parts):
            cut = pc.and_not(pc.match_substring_regex(parts, self.PLAIN), pc.match_substring(parts, "<|"))
            plain = cut.to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(parts.filter(pa.array(plain)))
        flat, words = flat_words(pc.replace_substring_regex(low, self.WORD, "\\1 "))
        codes, distinct = word_codes(flat)
        counts = np.ones(len(parts), np.int64)
        counts[plain] = words
        slots = np.empty(counts.sum(), np.int64)
        short = np.repeat(plain, counts)
        slots[short] = self._slots(distinct.to_pylist(), self.words, self.word_slot)[codes]
        slots[~short] = self._slots(parts.filter(pa.array(~plain)).to_pylist(), self.whole, self.part_slot)
        lengths = self.sizes[slots]
        sizes = np.diff(starts_of(lengths)[starts_of(counts)])
        return self.ids[ranges((np.cumsum(self.sizes) - self.sizes)[slots], lengths)], sizes


def token_pieces(docs: DataFrame, tokenizer_file: str, most: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Tokens of each document plus an end token, in pieces of at most `most`: doc_id, piece, start, length, ids_crc32.

    Only longer documents are cut. The tokenizer must drop white space, as word-level BPE does: the ids of a text are
    then those of its parts between white space, so a task encodes each distinct part once. The file's content, a fixed
    model, is a broadcast. A null text is an empty one: a single end token. `with_ids` adds the ids themselves.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PartEncoder(model.value)
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                flat, counts = flat_words(part.column("text"))
                codes, distinct = word_codes(flat)
                ids, sizes = encoder.encode(distinct)
                ids, sizes = np.append(ids, np.uint32(end_id)), np.append(sizes, 1)
                ends = np.cumsum(counts)
                codes = np.insert(codes, ends, len(sizes) - 1)  # the end token after each document's last part
                lengths = sizes[codes]
                tokens = ids[ranges((np.cumsum(sizes) - sizes)[codes], lengths)]
                bounds = starts_of(lengths)[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]
                total = np.diff(bounds)
                pieces = -(-total // most)
                owner = np.repeat(np.arange(len(total)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * most
                length = np.minimum(most, total[owner] - start)
                cuts = [tokens[a : a + n] for a, n in zip((bounds[owner] + start).tolist(), length.tolist(), strict=True)]
                out = {
                    "doc_id": part.column("doc_id").take(pa.array(owner)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in cuts], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array(cuts, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Bins:
    """Bins of a fixed capacity, found by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.rooms = 0  # bit r: some bin has room r

    def _list(self, b: int) -> None:
        self.by_room[self.room[b]].add(b)
        self.rooms |= 1 << self.room[b]

    def _unlist(self, b: int) -> None:
        r = self.room[b]
        self.by_room[r].discard(b)
        if not self.by_room[r]:
            self.rooms &= ~(1 << r)

    def open(self) -> int:
        self.items.append([])
        self.room.append(self.capacity)
        self._list(len(self.items) - 1)
        return len(self.items) - 1

    def tightest(self, size: int, but: int = -1) -> int:
        """The bin with the least room that still takes `size`, or -1."""
        left = self.rooms >> size
        while left:
            r = size + (left & -left).bit_length() - 1
            for b in self.by_room[r]:
                if b != but:
                    return b
            left &= left - 1
        return -1

    def change(self, b: int, less: list[int], more: list[int], sizes: list[int]) -> None:
        self._unlist(b)
        for i in less:
            self.items[b].remove(i)
            self.room[b] += sizes[i]
        for i in more:
            self.items[b].append(i)
            self.room[b] -= sizes[i]
        self._list(b)


def _exchange(bins: Bins, sizes: list[int], poor: int, partners: list[int]) -> bool:
    """One exchange that takes load from bin `poor` into a fuller bin: one for one, one for two, or two for one.

    The fuller bin gains what `poor` loses, so the sum of squared fills rises and the search must end.
    """
    own = bins.items[poor]
    singles = {}
    for i in own:
        singles.setdefault(sizes[i], [i])
    pairs = {}
    for n, i in enumerate(own):
        for j in own[n + 1 :]:
            pairs.setdefault(sizes[i] + sizes[j], [i, j])
    for b in partners:
        room = bins.room[b]
        if b == poor or room == 0 or room > bins.room[poor]:
            continue
        held = bins.items[b]
        best = (0, None, None)
        for n, i in enumerate(held):
            x = sizes[i]
            for given in (singles, pairs):
                for gain in range(min(room, bins.capacity - x), best[0], -1):
                    if x + gain in given:
                        best = (gain, given[x + gain], [i])
                        break
            for j in held[n + 1 :]:
                y = x + sizes[j]
                for gain in range(min(room, bins.capacity - y), best[0], -1):
                    if y + gain in singles:
                        best = (gain, singles[y + gain], [i, j])
                        break
        if best[0]:
            _, mine, theirs = best
            bins.change(poor, mine, theirs, sizes)
            bins.change(b, theirs, mine, sizes)
            return True
    return False


def pack(lengths: np.ndarray, capacity: int, partners: int = 256, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece: best fit from long to short, then local search.

    The search empties the least filled bin: each of its pieces moves to the tightest bin that takes it, and where
    none does, an exchange with a fuller bin passes load on. It stops at the lower bound of bins, or when a bin can't be
    emptied. `partners` and `steps` bound the search for one bin, not what is packed.
    """
    sizes = lengths.tolist()
    bins = Bins(capacity)
    for i in np.argsort(-lengths, kind="stable").tolist():
        b = bins.tightest(sizes[i])
        bins.change(bins.open() if b < 0 else b, [], [i], sizes)
    least = -(-int(lengths.sum()) // capacity)
    live = [b for b in range(len(bins.items)) if bins.items[b]]
    while len(live) > least:
        poor = max(live, key=lambda b: bins.room[b])
        order = sorted((b for b in live if bins.room[b] and b != poor), key=lambda b: -bins.room[b])[:partners]
        for _ in range(steps):
            for i in sorted(bins.items[poor], key=lambda i: -sizes[i]):
                b = bins.tightest(sizes[i], poor)
                if b >= 0 and bins.items[b]:
                    bins.change(poor, [i], [], sizes)
                    bins.change(b, [], [i], sizes)
            if not bins.items[poor] or not _exchange(bins, sizes, poor, order):
                break
        if bins.items[poor]:
            break
        bins._unlist(poor)
        live.remove(poor)
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for number, b in enumerate(live):
        at = 0
        for i in bins.items[b]:
            where[i], offset[i] = number, at
            at += sizes[i]
    return where, offset


def _packed(pieces: DataFrame, groups: int, capacity: int, round_number: int) -> DataFrame:
    """Pack each of `groups` equal groups of pieces in a task of its own."""
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_fill")]
    fields = ", ".join(f"`{c}` {t}" for c, t in pieces.select(*names).dtypes)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # Nothing but the pieces' own order decides, so a task that runs again packs alike.
        frame = frame.sort_values("_piece_id", kind="stable").reset_index(drop=True)
        where, offset = pack(frame["length"].to_numpy(np.int64), capacity)
        fill = np.bincount(where, weights=frame["length"]).astype(np.int64)
        number = (round_number * groups + int(frame["_group"].iloc[0])) * GROUP_PIECES * 4 + where
        return frame[names].assign(sequence_id=number, offset=offset, _fill=fill[where])

    dealt = pieces.select(*names).withColumn("_group", F.pmod(F.xxhash64("_piece_id", F.lit(round_number)), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(run, f"{fields}, sequence_id long, offset long, _fill long")


def pack_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to pieces with a `length` of at most `capacity`.

    Pieces are written once and dealt by a hash of their row number into groups of about 4,096, so each group sees
    the same mix of lengths and equal pieces spread. Groups are packed apart. Sequences that are not full enough give
    their pieces back; those of all groups are dealt and packed once more. Every piece is placed exactly once; an empty
    table gives an empty result.
    """
    numbered = stored(pieces.withColumn("_piece_id", F.monotonically_increasing_id()))
    first = stored(_packed(numbered, partitions_for(numbered.count(), GROUP_PIECES, 1), capacity, 0))
    loose = first.filter(F.col("_fill") < int(capacity * FULL_ENOUGH))
    groups = partitions_for(loose.count(), GROUP_PIECES, 1)
    second = _packed(loose, groups, capacity, 1).withColumn("sequence_id", -1 - F.col("sequence_id"))
    both = first.filter(F.col("_fill") >= int(capacity * FULL_ENOUGH)).unionByName(second)
    return both.select(*pieces.columns, "sequence_id", "offset")
