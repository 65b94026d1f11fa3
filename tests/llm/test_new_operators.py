"""Spelling variants, similarity join and prefix trie: their parts, and cases that small tables seldom have."""

import random
from collections import Counter

import brute_llm as brute
import numpy as np
import pytest
from conftest import odd_turns
from hypothesis import given, settings
from hypothesis import strategies as st

from textlens.llm import jaccard_join, prefix_trie, spelling

LETTERS = "abcé"


def _one_edit(word):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in LETTERS}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in LETTERS}
    return {w for w in out - {word} if len(w) >= 4}


@settings(max_examples=60, deadline=None)
@given(st.text(LETTERS, min_size=4, max_size=12), st.dictionaries(st.text(LETTERS, min_size=2, max_size=2), st.integers(1, 9)))
def test_every_near_word_shares_a_key(word, weights):
    """Whatever the common order of grams: pivots of one of the two words meet the other's prefix."""

    class Ranks(dict):
        def __missing__(self, gram):
            return (weights.get(gram, 5), gram)

    ranks = Ranks()

    def keys(w):
        prefix, pivots = spelling.prefix_and_pivots(w, ranks)
        assert abs(pivots[0] - pivots[1]) >= 2 and set(pivots) <= set(prefix) and len(prefix) <= 7
        return {k for i in pivots for k in spelling._pivot_keys(w, i)}, set().union(*(spelling._prefix_keys(w, i) for i in prefix))

    mine = keys(word)
    for other in _one_edit(word):
        theirs = keys(other)
        assert mine[0] & theirs[1] or theirs[0] & mine[1]


def test_forms_lead_to_roots_over_many_steps(spark):
    chain = [f"abcdef{'ghijklmnop'[:k]}" for k in range(5)]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(5 * 5**k)) + " zzzzzz" * 5 + " zzzzzy" * 5
    got = spelling.spelling_variants(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    found = {r["word"]: (r["form"], r["root"], r["n_near"]) for r in got.collect()}
    assert found == {w: (chain[k + 1] if k < 4 else None, chain[4], 2 if 0 < k < 4 else 1) for k, w in enumerate(chain)} | {"zzzzzz": (None, "zzzzzz", 1), "zzzzzy": (None, "zzzzzy", 1)}
    with pytest.raises(ValueError):
        spelling.spelling_variants(got, least_letters=3)


def test_variants_in_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = spelling.spelling_variants(docs, every=199)
    want = brute.spelling([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got.collect()), key=repr) == want
    assert any(r[1] for r in want) and sum(r[4] for r in want) > 100


def test_words_and_keys_are_not_broadcast(spark):
    """Spark takes the keys to be as large as the stored words, which are few here."""
    words = spark.createDataFrame([("abcdef", 30), ("abcdeg", 5), ("uvwxyz", 7)], "word string, n long")
    docs = spark.createDataFrame([(1, "abcdef " * 30 + "abcdeg " * 5)], "doc_id long, text string")
    near, found = spelling.near_words(words), spelling.spelling_variants(docs)
    for df in (near, found):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Broadcast" not in plan
    assert {(r["word"], r["near"]) for r in near.collect()} == {("abcdef", "abcdeg"), ("abcdeg", "abcdef")}
    assert {(r["word"], r["root"]) for r in found.collect()} == {("abcdef", "abcdef"), ("abcdeg", "abcdef")}


def test_long_and_odd_words(spark):
    words = ["a" * 30_000, "a" * 30_001, "ÀÉÿabc", "àÉÿabc", "×÷×÷×÷", "aaaaaa", "aaaaab", "aaaaba", "ababab", "bababa"]
    rows = [(i, " ".join([w.upper() if i == 1 and w.isascii() else w for w in words])) for i in range(5)] + [(None, None), (None, "ababab")]
    got = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), every=7)
    assert sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got.collect()), key=repr) == brute.spelling(rows, every=7)


def test_subsets_follow_from_their_elements():
    rng = np.random.default_rng(5)
    bands = jaccard_join.SizeBands(85)
    for n in (7, 13, 60, 500):
        values = np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64))
        counts = np.array([0, n, 0])
        band, segments, spare = bands.place(counts, False)
        names, first = jaccard_join.subset_names(values, counts, band, segments)
        assert first.tolist() == [0, 0, segments[1], segments[1]] and len(names) == segments[1] > 0
        less = jaccard_join.subset_names(values[1:], np.array([n - 1]), band[1:2], segments[1:2])[0]
        assert (names != less).sum() == 1


def test_bands_leave_no_link_out():
    """Linked sets of any sizes meet in a band with more equal subsets than either leaves out."""
    for percent in (50, 80, 85, 99):
        bands = jaccard_join.SizeBands(percent)
        sizes = np.arange(1, 400)
        own, lower = bands.place(sizes, False), bands.place(sizes, True)
        for a in range(1, 400):
            for b in range(a + 1, a * 100 // percent + 1):
                if b >= 400:
                    break
                band, m, spare = (x[a - 1] for x in own)
                other = next((x for x in (own, lower) if x[0][b - 1] == band), None)
                assert other is not None
                most = (100 - percent) * (a + b) // (100 + percent)
                if most:
                    assert other[1][b - 1] == m and m - most > max(spare, other[2][b - 1])


@pytest.mark.parametrize("costly", [1, 32])
def test_join_of_groups_with_many_far_copies(spark, monkeypatch, costly):
    """Copies of one text with few to many changes, so that components lie near one another."""
    monkeypatch.setattr(jaccard_join, "COSTLY", costly)
    rng = random.Random(3)
    rows = []
    for g, size in ((0, 40), (1, 120), (2, 400)):
        base = [f"g{g}w{i}" for i in range(size)]
        for k in range(45):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, size // 25, size // 12])):
                words[rng.randrange(size)] = f"new{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(docs).collect())
    want = sorted(brute.near_duplicates(rows, 4, 85))
    assert got == want and 3 < len({r[2] for r in want}) < len(rows)


def test_low_similarity_is_exact(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"{i // 8}x{j}" if rng.random() < 0.93 else f"r{rng.randrange(10**9)}" for j in range(60))) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (50, 60):
        got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(docs, 1, percent).collect())
        assert got == sorted(brute.near_duplicates(rows, 1, percent))
    with pytest.raises(ValueError):
        jaccard_join.SizeBands(49)


@pytest.mark.parametrize("shards", [1, 2, 17, 200])
def test_any_number_of_shards_gives_one_trie(spark, monkeypatch, shards):
    monkeypatch.setattr(prefix_trie, "ENDS_IN_PIECE", 7)
    turns = spark.createDataFrame(odd_turns(), "conv_id long, turn long, role string, text string")
    got = prefix_trie.prefix_trie(prefix_trie.with_borrowed_starts(turns), shards)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute.prefix_trie(odd_turns())


def test_skeleton_holds_what_crosses_a_splitter():
    def path(*turns):
        return b"".join(bytes([t]) * 16 for t in turns)

    skeleton = prefix_trie.Skeleton([(path(1, 2, 3), 5), (path(1, 2, 3), 9), (path(1, 4), 0)])
    assert skeleton.parent == [-1, 0, 1, 2, 1] and skeleton.depth == [0, 1, 2, 3, 2]
    assert [skeleton.shard(path(1, 2, 3), c) for c in (4, 5, 8, 9)] == [0, 1, 1, 2]
    assert skeleton.spine(0, path(1, 2, 2)) == [0, 1, 2] and skeleton.spine(3, path(2)) == [0]
    assert prefix_trie.common_turns(path(1, 2, 3), path(1, 2, 4)) == 2 and prefix_trie.common_turns(b"", path(1)) == 0


def test_ends_of_a_hot_path(spark):
    turns = [(c, t, "u", f"same {t}") for c in range(3000) for t in range(2)]
    rows = prefix_trie.prefix_trie(prefix_trie.with_borrowed_starts(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")), 40).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == brute.prefix_trie(turns)
    assert Counter(r["n_convs"] for r in rows) == {3000: 3}
