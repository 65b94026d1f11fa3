"""Quality rules on repetition inside a text, from a suffix array of its words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.shared import BLANKS, flat_words, slices, starts_of, word_codes

#: Text bytes whose suffix array is built at a time.
BATCH_BYTES = 4 << 20


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array by doubling, and the ranks of all prefixes of 1, 2, 4, ... symbols that were needed."""
    n = len(symbols)
    levels = [np.unique(symbols, return_inverse=True)[1].astype(np.int32)]
    step = 1
    while True:
        rank = levels[-1]
        # Only suffixes that share their rank are sorted again.
        same = np.bincount(rank, minlength=n)[rank] > 1
        if not same.any():
            return np.argsort(rank, kind="stable"), levels
        at = np.flatnonzero(same)
        follow = np.full(len(at), -1, np.int64)
        inside = at + step < n
        follow[inside] = rank[at[inside] + step]
        pair = rank[at].astype(np.int64) * (n + 1) + follow + 1
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        # New ranks: the first place of each group of equal pairs among all suffixes.
        first_of = np.cumsum(np.bincount(rank, minlength=n)) - np.bincount(rank, minlength=n)
        group = rank[at[order]]
        begins = np.concatenate([[True], group[1:] != group[:-1]])
        head = np.flatnonzero(begins)[np.cumsum(begins) - 1]
        fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
        leader = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        place = first_of[rank].astype(np.int32)
        place[at[order]] = first_of[group] + (leader - head)
        levels[-1] = first_of[rank].astype(np.int32)
        levels.append(place)
        step *= 2


def neighbour_lcp(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Common prefix of each suffix in order with the one before (0 for the first): ranks compared from long to short."""
    n = len(order)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    a, b = order[:-1].astype(np.int64), order[1:].astype(np.int64)
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        x, y = a + common, b + common
        live = np.flatnonzero((x < n) & (y < n))
        equal = live[rank[x[live]] == rank[y[live]]]
        common[equal] += 1 << k
    lcp[1:] = common
    return lcp


def repetition(words: np.ndarray, counts: np.ndarray, least: int, base: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: words in repeats of at least `base` words, of at least `least` words, of those the words that are
    not a first occurrence, and the longest repeat.

    The texts' suffixes are ordered together; each text ends in a symbol of its own, so that no common prefix leaves
    a text. The words of a suffix up to its longest common prefix with a neighbour are one occurrence of a
    maximal repeat (an interval of the prefix array); the union of those spans is what repeats cover. In an interval of
    common prefixes of `least` words, all occurrences but the one that comes first in the text say their words again.
    """
    texts = len(counts)
    ends = starts_of(counts + 1)
    symbols = np.empty(ends[-1], np.int64)
    owner = np.repeat(np.arange(texts), counts + 1)
    inside = np.ones(len(symbols), bool)
    inside[ends[1:] - 1] = False
    symbols[inside] = words + texts
    symbols[~inside] = np.arange(texts)
    # A common prefix may only join suffixes of one text: the text's number goes in front of each word's.
    _, symbols = np.unique(owner * (int(symbols.max(initial=0)) + 1) + symbols, return_inverse=True)
    order, levels = suffix_order(symbols)
    lcp = neighbour_lcp(order, levels)
    best = np.maximum(lcp, np.concatenate([lcp[1:], [0]]))  # the longest repeat that begins at a suffix
    longest = np.zeros(texts, np.int64)
    np.maximum.at(longest, owner[order], best)
    interval = np.cumsum(lcp < least)
    earliest = np.full(len(order) + 1, len(order), np.int64)
    np.minimum.at(earliest, interval, order)
    again = order != earliest[interval]

    def union(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + sizes, -1)
        return np.bincount(owner, weights=np.cumsum(edge)[:-1] > 0, minlength=texts).astype(np.int64)

    covered = [union(order[best >= floor], best[best >= floor]) for floor in (base, least)]
    return *covered, union(order[again], np.full(np.count_nonzero(again), least)), longest


def _measures(least: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string(), from_pandas=True)], ["text"])
            parts = [pd.DataFrame({"n_repeat_words": [], "covered_words": [], "repeated_words": [], "longest_repeat": []}, dtype=np.int64)]
            for part in slices(batch, "text", BATCH_BYTES):
                flat, counts = flat_words(part.column("text"))
                base, covered, repeated, longest = repetition(word_codes(flat)[0], counts, least)
                parts.append(pd.DataFrame({"n_repeat_words": base, "covered_words": covered, "repeated_words": repeated, "longest_repeat": longest}))
            yield pd.concat(parts, ignore_index=True)

    return run


def repetition_measures(text: Column, least: int = 8) -> Column:
    """A struct of n_repeat_words (words in 3-word windows that occur twice), covered_words (words in maximal repeats of
    at least `least` words), repeated_words (those of them in windows of `least` words that came before in the text) and
    longest_repeat (words)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _measures(least)(batches)

    return F.pandas_udf(run, "n_repeat_words long, covered_words long, repeated_words long, longest_repeat long")(text)


def with_quality(docs: DataFrame, least: int = 8, max_repeated: float = 0.15, max_longest: int = 100) -> DataFrame:
    """Documents with a struct `_quality`: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
    repeated_words, longest_repeat, base_failed, kept.

    A text is kept if its base rules hold (at least 50 words, not over half of them in repeated 3-word windows), if
    at most `max_repeated` of its words repeat what the text has said before (in repeats of at least `least` words, whose
    first occurrence does not count: of a line that comes twice, one half), and if no repeat is longer than `max_longest`
    words. Each text is judged alone and whole; copies of a text get the same verdict. A null or empty
    text has no words and fails. No column but `text` is read; columns of the same names stay apart in the struct.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = F.lit(BLANKS)
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, blank)) > 0)
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    measured = docs.withColumn("_repeats", repetition_measures(F.col("text"), least)).withColumn("_words_of", F.size(F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda x: F.length(x) > 0)).cast("long"))
    n, r = F.col("_words_of"), F.col("_repeats")
    failed = (n < 50) | (100 * r["n_repeat_words"] > 50 * n)
    verdict = (r["repeated_words"] <= max_repeated * n) & (r["longest_repeat"] <= max_longest)
    quality = F.struct(
        n.alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        r["n_repeat_words"].alias("n_repeat_words"),
        r["covered_words"].alias("covered_words"),
        r["repeated_words"].alias("repeated_words"),
        r["longest_repeat"].alias("longest_repeat"),
        failed.alias("base_failed"),
        (~failed & verdict).alias("kept"),
    )
    return measured.select(*[measured[c] for c in docs.columns], quality.alias("_quality"))
