"""Benchmark decontamination with a positional inverted index, kept in shards of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.shared import KEY, flat_words, ranges, slices, starts_of, stored, string_hashes, with_key, word_codes

#: Text bytes of one shard of the index; bytes of phrase text that are searched at a time, as a broadcast.
SHARD_BYTES, PHRASE_BYTES = 8 << 20, 16 << 20
#: ASCII signs that are no word characters become blanks; A-Z become lower case; bytes from 0x80 on stay.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def plain(texts: pa.Array) -> pa.Array:
    """Texts with all but words blanked out."""
    joined = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8)
    data = joined.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]].translate(WORD_BYTES) if len(joined) and joined.buffers()[2] else b""
    return pa.LargeStringArray.from_buffers(len(joined), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data))


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each word in the list of distinct words, hashes of those, and words of each text."""
    flat, counts = flat_words(plain(texts))
    codes, distinct = word_codes(flat)
    return codes, string_hashes(distinct), counts


def build_index(docs: DataFrame) -> DataFrame:
    """A positional index of documents, a row for each shard of about 8 MB of text, written to the shared folder.

    A row has the documents (doc_id, key, number of words) and, for each distinct term in order of its 64-bit hash, the
    increasing positions of the term. Positions count through the shard's words, and the numbers of words tell to which
    document a position belongs. A null text has no words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                codes, hashes, counts = hashed_words(part.column("text"))
                order = np.argsort(hashes)
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                codes = place[codes]
                by_term = np.argsort(codes, kind="stable")
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_ids": pa.array([part.column("doc_id").to_pylist()], pa.list_(part.column("doc_id").type)),
                        "keys_a": pa.array([part.column(KEY[0])], pa.list_(pa.int64())),
                        "keys_b": pa.array([part.column(KEY[1])], pa.list_(pa.int64())),
                        "n_words": pa.array([counts], pa.list_(pa.int64())),
                        "terms": pa.array([hashes[order].tobytes()], pa.binary()),
                        "term_counts": pa.array([np.bincount(codes, minlength=len(order)).astype(np.uint32).tobytes()], pa.binary()),
                        "postings": pa.array([by_term.astype(np.uint32).tobytes()], pa.binary()),
                    }
                )

    schema = f"doc_ids array<{kind}>, keys_a array<long>, keys_b array<long>, n_words array<long>, terms binary, term_counts binary, postings binary"
    return stored(with_key(docs.select("doc_id", "text")).mapInArrow(run, schema))


class Phrases:
    """Distinct phrases as rows of term hashes of one length, with the items that hold them."""

    def __init__(self, texts: list[str | None], window: int):
        codes, hashes, counts = hashed_words(pa.array(texts, pa.string()))
        starts = starts_of(counts)
        self.by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (phrases, item of pairs, phrase of pairs)
        sizes = np.minimum(counts, window)
        for size in np.unique(sizes[sizes > 0]).tolist():
            items = np.flatnonzero(sizes == size)
            each = counts[items] - size + 1
            at = ranges(starts[items], each)
            rows = hashes[codes[at[:, None] + np.arange(size)]]
            phrases, number = np.unique(rows, axis=0, return_inverse=True)
            self.by_length.append((phrases, np.repeat(items, each), number.reshape(-1)))


class Postings:
    """One shard of the index."""

    def __init__(self, terms: bytes, counts: bytes, postings: bytes, n_words: np.ndarray):
        self.terms = np.frombuffer(terms, np.uint64)
        self.counts = np.frombuffer(counts, np.uint32).astype(np.int64)
        self.starts = starts_of(self.counts)
        self.positions = np.frombuffer(postings, np.uint32).astype(np.int64)
        self.width = len(self.positions) + 1
        self.keys = np.repeat(np.arange(len(self.terms)), self.counts) * self.width + self.positions
        self.doc_starts = starts_of(n_words)

    def term_numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash among the shard's terms, -1 where it has none."""
        if not len(self.terms):
            return np.full(hashes.shape, -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def docs_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, positions, side="right") - 1

    def find(self, phrases: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first, last position) of all matches.

        Exact (slop 0): postings of the rarest term, shifted to where the phrase would begin, are intersected with the
        lists of the other terms, rarest first. With slop, terms follow one another in order and the match is at most
        `slop` words longer than the phrase; from each place of the first term, the nearest such match counts.
        """
        size = phrases.shape[1]
        terms = self.term_numbers(phrases)
        alive = np.flatnonzero((terms >= 0).all(axis=1))
        terms = terms[alive]
        order = np.argsort(self.counts[terms], axis=1, kind="stable") if slop == 0 else np.tile(np.arange(size), (len(alive), 1))
        rows = np.arange(len(alive))
        lead = terms[rows, order[:, 0]] if len(alive) else np.zeros(0, np.int64)
        n = self.counts[lead]
        which = np.repeat(rows, n)
        at = self.positions[ranges(self.starts[lead], n)]
        first = at - (order[which, 0] if slop == 0 else 0)
        at = first + size - 1 if slop == 0 else at
        for k in range(1, size):
            column = order[which, k]
            key = terms[which, column] * self.width + (first + column if slop == 0 else at + 1)
            found = np.searchsorted(self.keys, key)
            if slop == 0:
                ok = (first >= 0) & (self.keys[np.minimum(found, len(self.keys) - 1)] == key)
            else:
                got = self.keys[np.minimum(found, len(self.keys) - 1)]
                ok = (found < len(self.keys)) & (got // self.width == key // self.width)
                at = np.where(ok, got % self.width, at)
                ok &= at - first < size + slop
            which, first, at = which[ok], first[ok], at[ok]
        same = (first >= 0) & (self.docs_of(first) == self.docs_of(at))
        return alive[which[same]], first[same], at[same]


def search_index(index: DataFrame, items: DataFrame, window: int = 13, slop: int = 0) -> DataFrame:
    """Documents in which windows of item texts occur: key, `spans` (start, end in words, end exclusive), `items`.

    A window is `window` consecutive words of an item; an item with fewer words, but some, is one window. Items are
    searched against all shards in blocks of about 16 MB of text, each a broadcast of about that size: equal rows of
    items count once, so that a repeated one cannot fill a block. `items` needs item_id and text; a null id counts as an
    empty one, equal ids as one item, and a null text has no window.
    """
    spark = index.sparkSession
    items = stored(items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct())
    blocks = -(-max(1, items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PHRASE_BYTES)
    found = None
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        given = spark.sparkContext.broadcast(([r["item"] for r in rows], Phrases([r["text"] for r in rows], window)))

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            names, phrases = given.value
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i] for c in batch.schema.names}
                    shard = Postings(row["terms"].as_py(), row["term_counts"].as_py(), row["postings"].as_py(), row["n_words"].values.to_numpy())
                    spans: dict[int, list[tuple[int, int]]] = {}
                    held: dict[int, set[str]] = {}
                    for table, item_of, phrase_of in phrases.by_length:
                        which, first, last = shard.find(table, slop)
                        docs = shard.docs_of(first)
                        first, last = first - shard.doc_starts[docs], last + 1 - shard.doc_starts[docs]
                        for d, a, b in zip(docs.tolist(), first.tolist(), last.tolist(), strict=True):
                            spans.setdefault(d, []).append((a, b))
                        pairs = np.unique(docs * len(table) + which)
                        by_phrase = np.argsort(phrase_of, kind="stable")
                        lo = np.searchsorted(phrase_of[by_phrase], pairs % len(table), side="left")
                        hi = np.searchsorted(phrase_of[by_phrase], pairs % len(table), side="right")
                        for d, j in zip(np.repeat(pairs // len(table), hi - lo).tolist(), by_phrase[ranges(lo, hi - lo)].tolist(), strict=True):
                            held.setdefault(d, set()).add(names[item_of[j]])
                    order = sorted(spans)
                    merged = [_merged(spans[d]) for d in order]
                    yield pa.RecordBatch.from_arrays(
                        [
                            row["keys_a"].values.take(pa.array(order, pa.int64())),
                            row["keys_b"].values.take(pa.array(order, pa.int64())),
                            pa.array([[{"start": a, "end": b} for a, b in x] for x in merged], SPANS),
                            pa.array([sorted(held[d]) for d in order], pa.list_(pa.string())),
                        ],
                        names=[*KEY, "spans", "items"],
                    )

        part = index.select("keys_a", "keys_b", "n_words", "terms", "term_counts", "postings").mapInArrow(
            run, f"{KEY[0]} long, {KEY[1]} long, spans array<struct<start: int, end: int>>, items array<string>"
        )
        found = part if found is None else found.unionByName(part)
    # A document is in one shard, so a group has at most a row for each block of items and each repeated row.
    return found.groupBy(*KEY).agg(F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def words_in(spans: Column) -> Column:
    """Words inside the union of sorted spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))

    def add(acc: Column, x: Column) -> Column:
        gain = F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], acc["upto"]))
        return F.struct((acc["n"] + gain).alias("n"), F.greatest(acc["upto"], x["end"]).alias("upto"))

    return F.aggregate(spans, start, add, lambda acc: acc["n"]).cast("long")


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, share: float = 0.05) -> DataFrame:
    """A row for each document: doc_id, key, n_words, n_hit, items, spans, contaminated.

    A word is hit inside any occurrence of a window of an item; a document is contaminated if hit words are at least
    `share` of its words. Without hits, `items` and `spans` are empty. Rows with the same doc_id and text have the
    same result; null and empty texts have no words and are never contaminated; empty tables give no hits.
    """
    index = build_index(docs)
    rows = index.select(F.explode(F.arrays_zip("doc_ids", "keys_a", "keys_b", "n_words")).alias("d"))
    rows = rows.select(F.col("d.doc_ids").alias("doc_id"), F.col("d.keys_a").alias(KEY[0]), F.col("d.keys_b").alias(KEY[1]), F.col("d.n_words").alias("n_words"))
    joined = rows.join(search_index(index, items, window), list(KEY), "left")
    hit = F.coalesce(words_in(F.col("spans")), F.lit(0).cast("long"))
    per = round(1 / share)
    return joined.select(
        "doc_id",
        *KEY,
        "n_words",
        hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "spans",
        ((hit > 0) & (per * hit >= F.col("n_words"))).alias("contaminated"),
    )
