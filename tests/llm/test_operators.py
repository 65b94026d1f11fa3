"""The registered queries against plain versions, on rows with nulls, empty and long texts, ties and repeats."""

import zlib

import brute_llm as brute
import numpy as np
import public_tokenizers
import pytest

from textlens.llm.queries import QUERIES


def rows_of(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def run(spark, small_dir, name):
    return QUERIES[name](spark, small_dir)


def test_line_dedup(spark, small_dir, odd_rows):
    got = rows_of(run(spark, small_dir, "op3_line_dedup"), ["doc_id", "n_lines", "n_dropped", "kept_sha256"])
    assert got == brute.line_dedup(odd_rows)


def test_quality(spark, small_dir, odd_rows):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "repeated_words", "longest_repeat", "base_failed", "kept"]
    got = rows_of(run(spark, small_dir, "op4_quality_rules"), ["doc_id", *columns])
    assert got == sorted(((d, *brute.quality(t)) for d, t in odd_rows), key=repr)


def test_suffix_dedup(spark, small_dir, odd_rows):
    got = rows_of(run(spark, small_dir, "op5_suffix_array_dedup"), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    assert got == brute.earlier_substrings(odd_rows)


def test_sharding(spark, small_dir, odd_rows):
    got = run(spark, small_dir, "op6_sharding")
    assert rows_of(got, ["doc_id", "size", "text_crc32", "shard", "slot"]) == brute.shards(odd_rows)
    assert got.filter("law <> 'bytes' OR grown_shard IS NOT NULL").count() == 0


def test_pii(spark, small_dir, odd_rows):
    got = rows_of(run(spark, small_dir, "op7_pii"), ["doc_id", "base_sha256"])
    plain = [",".join(f"{k}:{s}:{e}" for k, s, e in brute.base_spans(t)) for _, t in odd_rows]
    assert got == sorted(((d, brute.sha(x)) for (d, _), x in zip(odd_rows, plain)), key=repr)


def test_substring_dedup(spark, small_dir, odd_rows):
    got = rows_of(run(spark, small_dir, "op8_substring_dedup"), ["doc_id", "n_words", "n_removed", "kept_sha256"])
    assert got == brute.repeated_passages(odd_rows)


def test_near_duplicates(spark, small_dir, odd_rows):
    got = run(spark, small_dir, "op9_minhash_near_dedup")
    assert rows_of(got, ["doc_id", "n_shingles", "component_id"]) == brute.near_duplicates(odd_rows)
    assert got.filter("kept <> (doc_id <=> component_id)").count() == 0


def test_decontamination(spark, small_dir, odd_rows):
    items = [tuple(r) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert rows_of(run(spark, small_dir, "op10_decontamination"), columns) == brute.contamination(odd_rows, items)


def test_pivotal_grams(spark, small_dir, odd_rows):
    got = rows_of(run(spark, small_dir, "op11_pivotal_grams"), ["word", "form", "root", "n", "n_near", "form_n"])
    assert got == brute.spelling(odd_rows)


def test_jaccard_join(spark, small_dir, odd_rows):
    got = rows_of(run(spark, small_dir, "op12_jaccard_join"), ["doc_id", "n_shingles", "component_id"])
    assert got == brute.near_duplicates(odd_rows, 4, 85)


def test_prefix_trie(spark, small_dir):
    turns = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").collect()]
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert rows_of(run(spark, small_dir, "op13_prefix_trie"), columns) == brute.prefix_trie(turns)


def test_token_counts(spark, small_dir, odd_rows):
    from textlens.llm.token_counts import WORD, word_end_pieces

    pieces = word_end_pieces(public_tokenizers.path("word_bpe_49k.json"))

    def greedy(word):
        symbols = [*word.encode()]
        symbols[-1] += 256
        n = at = 0
        while at < len(symbols):
            at = max(j for j in range(at + 1, len(symbols) + 1) if tuple(symbols[at:j]) in pieces)
            n += 1
        return n

    known = {}
    want = []
    for d, t in odd_rows:
        words = WORD.findall((t or "").lower())
        want.append((d, len(words), sum(known.setdefault(w, greedy(w)) for w in words)))
    assert rows_of(run(spark, small_dir, "op1_token_counts"), ["doc_id", "n_words", "n_tokens"]) == sorted(want, key=repr)


def test_packing(spark, small_dir, odd_rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t in odd_rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want.append((d, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = run(spark, small_dir, "op2_best_fit_packing").toPandas()
    found = [tuple(None if x != x else int(x) for x in r) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].values]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    for _, one in got.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert one.offset.tolist() == [0, *one.length.cumsum().tolist()[:-1]] and one.length.sum() <= 2048
    assert got.sequence_id.nunique() == -(-got.length.sum() // 2048)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, none, name):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    none.withColumnRenamed("doc_id", "item_id").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


CLASHES = "doc_id long, text string, block long, shard int, `set` string, n_words string, _line_x int, bands array<int>, kept string, label string, value double, node int"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_extra_columns(spark, tmp_path, name):
    row = (1, "some text of a few words", 5, 6, "s", "n", 7, [1], "k", None, 1.0, 2)
    spark.createDataFrame([row, (2, *row[1:]), (None, None, *[None] * 10)], CLASHES).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b", "x")], "item_id long, text string, doc_id string").write.parquet(f"{tmp_path}/benchmark.parquet")
    turn = "conv_id long, turn int, role string, text string, bucket string, turns int, path string, words long, mark string, lent int, shard long, node string"
    turns = [(c, k, "r", f"t {k}", "b", 1, "p", 2, "m", 3, 4, "n") for c in (1, 2) for k in range(2)]
    spark.createDataFrame(turns, turn).write.parquet(f"{tmp_path}/conversations.parquet")
    # A word must come five times, and a root has no turn; all else has a row for each document.
    rows = {"op11_pivotal_grams": 0, "op13_prefix_trie": len(brute.prefix_trie([t[:4] for t in turns]))}
    assert QUERIES[name](spark, str(tmp_path)).count() == rows.get(name, 3)
