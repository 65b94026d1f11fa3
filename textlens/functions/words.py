"""Terms of a column of texts as numbers: small Arrow and numpy steps for tasks that count terms."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at a time: arrays of about ten times that size are made.
PART_BYTES = 8 << 20
SPACE = 32


@dataclass
class Terms:
    """Occurrences of terms: the text's place and the term's place in ``names``, which may hold unused ones."""

    rows: np.ndarray
    codes: np.ndarray
    names: pa.Array


def text_parts(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts of about PART_BYTES together, without the null ones; at least one part."""
    texts = texts.drop_null().cast(pa.string())
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while True:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + PART_BYTES, "right")))
        yield texts.slice(low, high - low)
        low = high
        if low >= len(texts):
            return


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(text's place, word) of all words of two or more characters, in order. Words end at spaces, as in word_tokens."""
    if not len(texts):
        return np.zeros(0, np.int64), pa.array([], pa.string())
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = data != SPACE
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    full = np.flatnonzero(ends[1:] > ends[:-1])
    begins[ends[full]] = inside[ends[full]]
    closes[ends[full + 1] - 1] = inside[ends[full + 1] - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    sizes = stops - starts
    if len(data) and data.max() > 127:
        characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        short = characters[stops] - characters[starts] < 2
    else:
        short = sizes < 2
    # Bytes of the words alone, one after the other.
    change = np.zeros(len(data) + 1, np.int8)
    change[starts[short]] = 1
    change[stops[short]] -= 1
    kept = data[inside & (np.cumsum(change[:-1], dtype=np.int8) == 0)]
    starts, sizes = starts[~short], sizes[~short]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return np.searchsorted(ends, starts, "right") - 1, words


def terms_of(texts: pa.Array, stop_words: Iterable[str], bigrams: bool) -> Terms:
    """The terms of `operators.tfidf.with_terms`: words without stop words, and with ``bigrams`` pairs of what is left."""
    rows, words = split_words(texts)
    coded = words.dictionary_encode()
    codes, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    stops = pc.is_in(names, value_set=pa.array(sorted(set(stop_words)), pa.string())).to_numpy(zero_copy_only=False)
    wanted = ~stops[codes]
    rows, codes = rows[wanted], codes[wanted]
    if not bigrams:
        return Terms(rows, codes, names)
    n = len(names)
    at = np.flatnonzero(rows[1:] == rows[:-1])
    pairs, place = np.unique(codes[at] * n + codes[at + 1], return_inverse=True)
    joined = pc.binary_join_element_wise(names.take(pa.array(pairs // max(n, 1))), names.take(pa.array(pairs % max(n, 1))), " ")
    return Terms(np.concatenate([rows, rows[at]]), np.concatenate([codes, n + place]), pa.concat_arrays([names, joined]))


def term_counts(texts: pa.Array, stop_words: Iterable[str], bigrams: bool) -> pa.RecordBatch:
    """(term, df, ctf) of texts that are not null. The row with a null term counts the texts."""
    found = terms_of(texts, stop_words, bigrams)
    size = len(found.names)
    ctf = np.bincount(found.codes, minlength=size)
    seen = np.flatnonzero(ctf)
    cells = np.sort(found.rows * size + found.codes)
    cells = cells[np.concatenate([[True], cells[1:] != cells[:-1]])] if len(cells) else cells
    df = np.bincount(cells % max(size, 1), minlength=size)[seen]
    terms = pa.concat_arrays([found.names.take(pa.array(seen)), pa.nulls(1, pa.string())])
    return pa.RecordBatch.from_arrays(
        [terms, pa.array(np.append(df, len(texts)), pa.int64()), pa.array(np.append(ctf[seen], 0), pa.int64())], names=["term", "df", "ctf"]
    )
