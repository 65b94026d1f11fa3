"""The parts of the operators on their own: orders, indexes, searches, packing, streams over partition edges."""

import random
from collections import Counter

import brute_llm as brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textlens.llm import decontamination, line_dedup, near_dedup, packing, pii, quality, sharding, suffix_dedup, substring_dedup, token_counts, windows


def test_induced_sort_and_prefixes():
    rng = random.Random(1)
    for _ in range(120):
        n, kinds, depth = rng.randint(1, 150), rng.choice([1, 2, 3, 20]), rng.choice([3, 5, 50])
        text = [rng.randint(1, kinds) for _ in range(n)] + [0]
        order, common = suffix_dedup.InducedSort(np.array(text, np.uint16), depth, rng.choice([0, 100, 1 << 20])).run()
        assert sorted(order.tolist()) == list(range(n + 1))
        for i in range(1, n + 1):
            a, b = text[order[i - 1] :], text[order[i] :]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert a[:depth] <= b[:depth] and common[i] == min(same, depth)


def test_solvers():
    rng = random.Random(2)
    for _ in range(60):
        size = rng.randint(2, 6)
        segments = [[rng.randint(1, 3) for _ in range(rng.randint(size, 30))] for _ in range(rng.randint(1, 6))]
        starts, symbols = np.cumsum([0, *map(len, segments)]), np.array(sum(segments, []))
        ids, places = (np.array([rng.randint(1, k) for _ in segments]) for k in (50, 2))
        cut = [(tuple(x[i : i + size]), v, c) for x, v, c in zip(segments, ids, places) for i in range(len(x) - size + 1)]
        count = Counter()
        for w, _, c in cut:
            count[w] += c
        least = {w: min(v for x, v, _ in cut if x == w) for w in count}
        assert suffix_dedup.least_ids(size)(symbols.astype(np.uint8), starts, ids).tolist() == [least[w] for w, _, _ in cut]
        assert substring_dedup.places(size)(symbols.astype(np.uint64), starts, places).tolist() == [min(2, count[w]) for w, _, _ in cut]


def test_matching_statistics():
    rng = random.Random(3)
    for _ in range(40):
        text = [rng.randint(1, 3) for _ in range(60)]
        query = np.array([rng.randint(1, 3) for _ in range(40)])
        index = substring_dedup.FMIndex(np.array([*text, 0]), np.array([1] * 60 + [0]))
        got = index.matching_statistics(query, np.array([0, 40]), 1)

        def found(part):
            return any(text[i : i + len(part)] == part for i in range(len(text) - len(part) + 1))

        want = [max(k for k in range(41 - i) if found(query[i : i + k].tolist())) for i in range(40)]
        assert got.tolist() == want


def test_windows_over_shards_and_frequent_anchors(spark, odd, odd_rows, monkeypatch):
    for name, value in (("BLOCK_BYTES", 2000), ("SHARD_BYTES", 20_000), ("FREQUENT", 3), ("BROADCAST_BYTES", 0)):
        monkeypatch.setattr(windows, name, value)
    rows = [r for r in odd_rows if len(r[1] or "") < 10_000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup.without_earlier_substrings(docs).select("doc_id", "n_symbols", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect()), key=repr) == brute.earlier_substrings(rows)
    got = substring_dedup.without_repeated_passages(docs).select("doc_id", "n_symbols", "n_removed", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect()), key=repr) == brute.repeated_passages(rows)


def test_hot_line_over_many_partitions(spark):
    rows = [(i, "hot\nhot\nown " + str(i) + ("\ntwice" if i < 2 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = line_dedup.line_bitmaps(docs, 10, partitions=16)
    assert found.count() == 300 and found.agg(F.min("_n_dropped"), F.max("_n_dropped")).first() == (2, 2)
    once = line_dedup.line_bitmaps(docs, 2, keep_first=True, partitions=16)
    assert once.agg(F.sum("_n_dropped")).first()[0] == 600 - 1 + 1


def test_line_count_at_the_bound(spark):
    rows = [(i, "nine" if i < 9 else "ten") for i in range(19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["_n_dropped"] for r in line_dedup.without_repeated_lines(docs, 10).collect()}
    assert [got[i] for i in range(19)] == [0] * 9 + [1] * 10


def test_bitmap_round_trip(spark, odd, odd_rows):
    kept = line_dedup.without_repeated_lines(odd, 10)
    got = sorted(((r["doc_id"], brute.sha(r["_kept_text"] or "")) for r in kept.collect()), key=repr)
    assert got == sorted(((d, x) for d, _, _, x in brute.line_dedup(odd_rows)), key=repr)


def test_word_suffix_array():
    rng = random.Random(4)
    texts = [[rng.choice("abcd") for _ in range(rng.randint(0, 40))] for _ in range(30)]
    words, counts = np.array([ord(c) for t in texts for c in t], np.int64), np.array([len(t) for t in texts])
    base, covered, again, longest = quality.repetition(words, counts, 5)
    for i, t in enumerate(texts):
        assert base[i] == len(brute.repeats(t, 3)) and covered[i] == len(brute.repeats(t, 5)) and again[i] == len(brute.said_again(t, 5))
        assert longest[i] == max((k for k in range(1, len(t)) if brute.repeats(t, k)), default=0)


def test_local_search_beats_best_fit_alone():
    # Best fit from long to short needs four bins here; exchanges reach three.
    lengths = np.array([44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 100 - 44 - 24 - 22 + 50])
    where, offset = packing.pack(lengths, 100)
    fills = np.bincount(where, weights=lengths)
    assert fills.max() <= 100 and len(fills) <= -(-lengths.sum() // 100) + 1
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = rng.integers(1, 700, 300)
        where, offset = packing.pack(lengths, 2048)
        fills = np.bincount(where, weights=lengths)
        assert fills.max() <= 2048 and len(fills) <= -(-lengths.sum() // 2048) + 1
        for b in range(len(fills)):
            at = np.flatnonzero(where == b)
            at = at[np.argsort(offset[at])]
            assert offset[at].tolist() == [0, *np.cumsum(lengths[at])[:-1].tolist()]


def test_exchange_raises_squared_fill():
    bins = packing.Bins(10)
    sizes = [5, 4, 3, 3]
    for items in ([1, 2], [0, 3]):
        bins.change(bins.open(), [], items, sizes)
    before = sum((10 - r) ** 2 for r in bins.room)
    assert packing._exchange(bins, sizes, 0, [1])
    assert sum((10 - r) ** 2 for r in bins.room) > before


def test_pack_pieces_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 64)
    pieces = spark.range(2000).select(F.col("id").alias("doc_id"), (1 + F.pmod(F.xxhash64("id"), F.lit(900))).alias("length"))
    got = packing.pack_pieces(pieces, 2048).toPandas()
    assert len(got) == 2000 and got.doc_id.nunique() == 2000
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= 1.01 * -(-got.length.sum() // 2048)


def test_automaton_pops_counts():
    pieces = {tuple(map(ord, p)) for p in ("a", "b", "c", "d", "ab", "abc", "bcd", "abcde"[:4] + "x")} | {(ord("x"),)}
    automaton = token_counts.PieceAutomaton(pieces)
    rng = random.Random(6)
    for _ in range(200):
        word = [ord(rng.choice("abcdx")) for _ in range(rng.randint(1, 12))]
        n = at = 0
        while at < len(word):
            at = max(j for j in range(at + 1, len(word) + 1) if tuple(word[at:j]) in pieces)
            n += 1
        old, token_counts.LAST = token_counts.LAST, 0
        try:
            got = automaton.counts(np.array(word, np.uint8), np.array([0]), np.array([len(word)]))
        finally:
            token_counts.LAST = old
        assert got.tolist() == [n]


def test_sketch_agreement_is_similarity():
    rng = np.random.default_rng(7)
    for share in (0.5, 0.85):
        both = rng.integers(0, 2**62, 4000).astype(np.uint64)
        n = round(4000 * share)
        extra = (4000 - n) // 2
        a, b = both[: n + extra], np.concatenate([both[:n], both[n + extra : n + 2 * extra]])
        sketch = near_dedup.similarity_sketches(np.concatenate([a, b]), np.array([len(a), len(b)]), 252)
        assert abs((sketch[0] == sketch[1]).mean() - n / (n + 2 * extra)) < 0.1
    tiny = near_dedup.similarity_sketches(np.array([5], np.uint64), np.array([1, 0]), 252)
    assert (tiny[0] != 0).all() and (tiny[1] == 0).all()


def test_large_group_of_near_copies(spark, monkeypatch):
    """Copies that differ in ways of their own: some pairs are too far apart, but links reach all."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        words = base[:]
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(500 + i, " ".join(f"y{i}z{j}" for j in range(50))) for i in range(20)]
    for rows_of_band, bands in ((7, 36), (1, 40)):
        monkeypatch.setattr(near_dedup, "ROWS", rows_of_band)
        monkeypatch.setattr(near_dedup, "BANDS", bands)
        got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(brute.near_duplicates(rows))


def test_first_elements_of_differences():
    """Any two linked sets of which one is not linked with the pivot share one of them."""
    rng = random.Random(11)
    for percent in (80, 85):
        seen = 0
        for _ in range(4000):
            p = {rng.randrange(60) for _ in range(40)}

            def near(s):
                out = set(s)
                for _ in range(rng.randint(0, 7)):
                    out.discard(rng.choice(sorted(out)))
                    if rng.random() < 0.6:
                        out.add(rng.randrange(60, 90))
                return out

            x = near(p)
            y = near(x)
            arrays = [np.array(sorted(s), np.uint64) for s in (p, x, y)]
            (lx, fx, dx), (ly, fy, dy) = (near_dedup.compared(arrays[0], a, percent) for a in arrays[1:])
            linked = 100 * len(x & y) >= percent * len(x | y)
            if linked and x != y and not (lx and ly) and x != p and y != p:
                seen += 1
                both = [e for e in fx.tolist() if e in set(fy.tolist())]
                rest = min(dx - fx.tolist().index(both[0]), dy - fy.tolist().index(both[0]))
                assert 2 * rest >= dx + dy - (len(x) + len(y)) * (100 - percent) // (100 + percent)
        assert seen > 100


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = dict(map(tuple, near_dedup.components(links).select("node", "label").collect()))
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "The quick, brown fox jumps"), (2, "quick red brown fox"), (3, "fox"), (4, "brown quick")], "doc_id long, text string")
    index = decontamination.build_index(docs)
    items = spark.createDataFrame([(7, "quick brown fox")], "item_id long, text string")

    def found(slop):
        hits = decontamination.search_index(index, items, 3, slop)
        ids = decontamination.contamination(docs, items, 3)
        joined = hits.join(ids.select("doc_id", *decontamination.KEY), list(decontamination.KEY))
        return {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in joined.collect()}

    assert found(0) == {1: [(1, 4)]}
    assert found(1) == {1: [(1, 4)], 2: [(0, 4)]}


def test_blocks_of_items_give_the_same(spark, small_dir, odd, monkeypatch):
    items = spark.read.parquet(f"{small_dir}/benchmark.parquet")
    columns = ["doc_id", "n_words", "n_hit", "items", "contaminated"]
    one = sorted(map(str, decontamination.contamination(odd, items).select(columns).collect()))
    monkeypatch.setattr(decontamination, "PHRASE_BYTES", 30)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 500)
    assert sorted(map(str, decontamination.contamination(odd, items).select(columns).collect())) == one


@pytest.mark.parametrize("text", ["a@b.c_d@e.f", "..@x.y", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.3.4", "4111 1111-1111 1111", "+1 (234) 567-8901)", "++49 30 1234567", "a@b", "@", "x@y.z@w.v", "+1", "é@x.de"])
def test_base_patterns(text):
    assert pii.base_spans(text) == brute.base_spans(text)


def test_base_patterns_on_random_texts():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice("a1 2.3-@+()_9é") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == brute.base_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 300_000, "1.2" * 60_000, "+1 " * 50_000, "a@" * 100_000):
        pii.base_spans(text)


def test_field_on_held_out_texts(spark):
    """Keys and phones without a plus are found in texts that were not used to train; numbers of other kinds are not."""
    rng = random.Random(10)

    def text(i):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(12)]
        number = f"({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
        add = [f"+{rng.randint(1, 99)} {number}", f'token = "{rng.getrandbits(160):040x}"', f"{rng.choice('xyz')}.{i}@mail.example.com", f"version {i % 7}.0", f"in {1900 + i % 100}"][i % 5]
        return " ".join([*words[:6], add, *words[6:]]), add

    train = [text(i) for i in range(300)]
    weights = pii.fit([x for t, _ in train for x in pii.labelled_windows(t)])
    good = bad = 0
    for i in range(300, 400):
        t, add = text(i)
        if i % 5 == 0:
            t, add = t.replace("+", "", 1), add[1:]
        _, added = pii.all_spans(t, weights, 4.0)
        found = {(k, t[s:e]) for k, s, e in added}
        if i % 5 == 0:
            good += ("phone", add) in found
        elif i % 5 == 1:
            good += ("secret", add.split('"')[1]) in found
        else:
            bad += len(found)
    assert good >= 36 and bad == 0


def test_contiguous_shards_of_equal_rows(spark):
    docs = spark.createDataFrame([(5, "same")] * 400 + [(6, "x" * 90)], "doc_id long, text string").repartition(3)
    got = sharding.shard_documents(docs, 8).groupBy("shard").agg(F.sum("size").alias("size"), F.max("slot").alias("last"), F.count("*").alias("n")).toPandas()
    assert len(got) == 8 and got["size"].max() - got["size"].min() <= 110 and (got["last"] == got["n"] - 1).all()


def test_flat_words_edges():
    from textlens.llm.shared import flat_words

    flat, counts = flat_words(pa.array(["  a b ", None, "", "\t\n", "c\x1fd e"]))
    assert flat.to_pylist() == ["a", "b", "c\x1fd e"] and counts.tolist() == [2, 0, 0, 0, 1]
