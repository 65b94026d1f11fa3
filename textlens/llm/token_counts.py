"""Word-piece counts by a longest-match automaton over the vocabulary."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from textlens.llm.shared import flat_words, slices, word_codes

#: Added to the symbol of a word's last byte: pieces that end a word differ from those inside.
LAST = 256
SYMBOLS = 512
#: Words of the vocabulary: runs of letters, single digits, runs of other signs.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
BATCH_BYTES = 8 << 20


class PieceAutomaton:
    """A trie of pieces whose failure links carry the number of pieces popped on the way.

    `pieces` are tuples of symbols (bytes, plus 256 for a word's last byte); every single symbol must be one. In a
    node for the string s, `pops` is how many pieces the greedy longest match takes off before what remains is again
    the start of a piece, `fail` is the node of that remainder, and `rest` is the number of pieces of s itself. A word
    is read once: each symbol moves down an edge or along failure links, and no piece is ever built.
    """

    def __init__(self, pieces: set[tuple[int, ...]]):
        edges: dict[int, int] = {}
        ends, parents = [False], [(0, 0)]
        for piece in sorted(pieces):
            node = 0
            for symbol in piece:
                key = node * SYMBOLS + symbol
                if key not in edges:
                    edges[key] = len(ends)
                    ends.append(False)
                    parents.append((node, symbol))
                node = edges[key]
            ends[node] = True
        depth = [0] * len(ends)
        for node in range(1, len(ends)):  # a parent has a smaller number
            depth[node] = depth[parents[node][0]] + 1
        fail, pops, rest = [-1] * len(ends), [0] * len(ends), [0] * len(ends)
        for node in sorted(range(1, len(ends)), key=depth.__getitem__):
            parent, symbol = parents[node]
            if ends[node]:
                fail[node], pops[node], rest[node] = 0, 1, 1
                continue
            z, popped = fail[parent], pops[parent]
            while z * SYMBOLS + symbol not in edges:
                if z <= 0:
                    raise ValueError(f"the vocabulary has no piece of the single symbol {symbol}")
                popped += pops[z]
                z = fail[z]
            fail[node], pops[node] = edges[z * SYMBOLS + symbol], popped
            rest[node] = popped + rest[fail[node]]
        keys = np.array(sorted(edges), np.int64)
        self.keys, self.to = keys, np.array([edges[k] for k in keys.tolist()], np.int32)
        self.fail, self.pops, self.rest = np.array(fail, np.int32), np.array(pops, np.int32), np.array(rest, np.int32)

    def counts(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Pieces of each word, given the words' bytes. Words advance side by side, one symbol a step."""
        order = np.argsort(-lengths, kind="stable")
        start, length = starts[order], lengths[order]
        node, count = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        live = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
        for i, n in enumerate(live):
            symbol = data[start[:n] + i].astype(np.int64)
            symbol += LAST * (length[:n] == i + 1)
            todo = np.arange(n)
            while len(todo):
                key = node[todo] * SYMBOLS + symbol[todo]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                node[todo[hit]] = self.to[at[hit]]
                todo = todo[~hit]
                count[todo] += self.pops[node[todo]]
                node[todo] = self.fail[node[todo]]
        out = np.empty(len(order), np.int64)
        out[order] = count + self.rest[node]
        return out


def byte_symbols() -> dict[str, int]:
    """The printable signs that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def word_end_pieces(path: str) -> set[tuple[int, ...]]:
    """The pieces of a byte-level vocabulary file whose word-ending pieces carry a suffix."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    suffix, symbols = model["end_of_word_suffix"], byte_symbols()
    pieces = set()
    for piece in model["vocab"]:
        ends = piece.endswith(suffix)
        ids = [symbols[c] for c in (piece[: -len(suffix)] if ends else piece)]
        pieces.add((*ids[:-1], ids[-1] + LAST * ends))
    return pieces


def token_counts(spark: SparkSession, text: Column, vocabulary: str) -> Column:
    """A struct of n_words and n_tokens of a text: greedy word pieces of its words, in lower case.

    Words are runs of letters, single digits, runs of other signs and the vocabulary's contractions. A task reads each
    distinct word of a few MB of text once. The automaton, bounded by the vocabulary, is a broadcast. Null and empty
    texts have no words; texts of any length are read whole.
    """
    shared = spark.sparkContext.broadcast(PieceAutomaton(word_end_pieces(vocabulary)))

    def chunk_counts(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words and pieces of each distinct string between white space."""
        found = [WORD.findall(x.lower()) for x in chunks.to_pylist()]
        per = np.fromiter(map(len, found), np.int64, len(found))
        words = pa.array([w for ws in found for w in ws], pa.string())
        codes, distinct = word_codes(words)
        data = np.frombuffer(b"".join(x.encode() for x in distinct.to_pylist()), np.uint8)
        lengths = pc.binary_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
        counts = shared.value.counts(data, np.cumsum(lengths) - lengths, lengths)
        owner = np.repeat(np.arange(len(per)), per)
        return per, np.bincount(owner, weights=counts[codes], minlength=len(per)).astype(np.int64)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string(), from_pandas=True)], ["text"])
            parts = [pd.DataFrame({"n_words": [], "n_tokens": []}, dtype=np.int64)]
            for part in slices(batch, "text", BATCH_BYTES):
                flat, per = flat_words(part.column("text"))
                codes, chunks = word_codes(flat)
                words, tokens = chunk_counts(chunks)
                owner = np.repeat(np.arange(len(per)), per)
                sums = [np.bincount(owner, weights=x[codes], minlength=len(per)).astype(np.int64) for x in (words, tokens)]
                parts.append(pd.DataFrame({"n_words": sums[0], "n_tokens": sums[1]}))
            yield pd.concat(parts, ignore_index=True)

    return F.pandas_udf(run, "n_words long, n_tokens long")(text)
