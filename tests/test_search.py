import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from textlens.functions.constants import ENGLISH_STOP_WORDS
from textlens.operators import scoring
from textlens.operators import search as s
from textlens.operators.tfidf import TfidfSettings, fit_tfidf
from textlens.sources import index
from textlens.sources.reviews import queries_from_list

SETTINGS = TfidfSettings(1, 1.0, 100)
QUERIES = ["dirty ROOM, noisy!", "great staff", "unknown words", "room"]


def ranking(texts, query, k):
    vocab = brute.vocabulary(list(texts.values()), ENGLISH_STOP_WORDS)
    asked = brute.weights(query, vocab, ENGLISH_STOP_WORDS)
    scores = {d: brute.dot(asked, brute.weights(t, vocab, ENGLISH_STOP_WORDS)) for d, t in texts.items()}
    return [(d, pytest.approx(scores[d])) for d in sorted(scores, key=lambda d: (-round(scores[d], 6), d))[:k]]


@pytest.fixture(scope="module")
def texts(corpus):
    return {r["doc_id"]: r["clean_text"] for r in corpus.collect()}


@pytest.mark.parametrize("fetched", [1000, 0])
@pytest.mark.parametrize("query, clean", list(zip(QUERIES, ["dirty room noisy", *QUERIES[1:]])))
def test_free_text(corpus, texts, monkeypatch, query, clean, fetched):
    monkeypatch.setattr(s, "FETCHED_ROWS", fetched)
    rows = s.search_by_query(corpus, query, 6, SETTINGS).collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [(r["doc_id"], r["score"]) for r in rows] == ranking(texts, clean, 6)
    assert all(r["text"] == texts[r["doc_id"]] for r in rows)


def test_by_document(corpus, texts):
    rows = s.search_by_row(corpus, 2, 10, SETTINGS).collect()
    assert rows[0]["doc_id"] == 5 and rows[0]["score"] == pytest.approx(1.0)
    assert rows[-1]["doc_id"] == 2 and rows[-1]["score"] == -1.0
    assert 2 not in [r["doc_id"] for r in s.search_by_row(corpus, 2, 9, SETTINGS).collect()]
    with pytest.raises(IndexError):
        s.search_by_row(corpus, 99, 3, SETTINGS)
    with pytest.raises(ValueError):
        s.search(corpus)


@pytest.mark.parametrize("docs_at_once", [4096, 2])
def test_many_queries(spark, corpus, texts, monkeypatch, docs_at_once):
    """All queries at once and few a block, large and small document blocks: the same rows."""
    monkeypatch.setattr(scoring, "BLOCK_DOCS", docs_at_once)
    monkeypatch.setattr(scoring, "SCORES_AT_ONCE", 8)
    model = fit_tfidf(corpus, SETTINGS)
    vectors = model.with_vectors(corpus).repartition(2, "doc_id").persist()
    queries = queries_from_list(spark, QUERIES)
    columns = ["query_id", "query", "rank", "score", "doc_id"]
    found = scoring.search_vectors(vectors, model, queries, 7)
    once = sorted(found.select(*columns).collect())
    for most in (3, 1):
        assert sorted(scoring.search_vectors(vectors, model, queries, 7, most).select(*columns).collect()) == once
    for i, clean in enumerate(["dirty room noisy", *QUERIES[1:]], start=1):
        rows = found.filter(F.col("query_id") == i).orderBy("rank").collect()
        assert [(r["doc_id"], r["score"]) for r in rows] == ranking(texts, clean, 7)
    top = {r["query_id"]: r for r in s.query_summary(found).collect()}
    assert top[3]["top_score"] == 0.0
    assert top[2]["mean_top_k_score"] == pytest.approx(sum(r["score"] for r in found.filter("query_id = 2").collect()) / 7)


@pytest.mark.parametrize("most", [None, 3])
def test_ids_of_any_type(spark, corpus, texts, most):
    """Strings as ids of documents and queries, a repeated query id, an empty query, more asked for than there is."""
    named = corpus.withColumn("doc_id", F.concat(F.lit("doc "), F.col("doc_id").cast("string")))
    model = fit_tfidf(named, SETTINGS)
    queries = spark.createDataFrame([("a", "great staff"), ("b", ""), ("a", "noisy room"), (None, "dirty")], "query_id string, query string")
    rows = scoring.search_vectors(model.with_vectors(named), model, queries, 20, most).collect()
    assert len(rows) == 4 * 10
    for query in ("great staff", "", "noisy room", "dirty"):
        got = sorted((r["rank"], r["doc_id"], r["score"]) for r in rows if r["query"] == query)
        assert [(d, x) for _, d, x in got] == [(f"doc {d}", x) for d, x in ranking(texts, query, 20)]


def test_saved_blocks_give_the_same_rows(spark, corpus, tmp_path, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_DOCS", 3)
    named = corpus.select(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("doc_id"), "clean_text")
    documents = named.select("doc_id", F.lit("").alias("hotel_name"), F.lit(1.0).alias("reviewer_score"), F.lit("").alias("text_excerpt"))
    model = fit_tfidf(named, SETTINGS)
    built = index.SearchIndex(model, documents, model.with_vectors(named))
    index.save_index(built, str(tmp_path))
    queries = spark.createDataFrame([(f"q{i}", q) for i, q in enumerate(QUERIES)], "query_id string, query string")
    columns = ["query_id", "query", "rank", F.round("score", 12), "doc_id"]
    want = sorted(built.search(queries, 4).select(*columns).collect())
    for pushed in (1000, 0):
        monkeypatch.setattr(index, "PUSHED_TERMS", pushed)
        loaded = index.load_index(spark, str(tmp_path))
        assert sorted(loaded.search(queries, 4).select(*columns).collect()) == want
    assert loaded.statistics().collect() == built.statistics().collect()
    with pytest.raises(ValueError):
        index.save_index(loaded, str(tmp_path / "again"))


def test_blocks_below_the_best_are_skipped():
    """Kernel against plain sums; blocks come best first, so that later ones can be left out."""
    rng = np.random.default_rng(1)
    dense = np.where(rng.random((400, 30)) < 0.2, rng.random((400, 30)), 0.0) * np.linspace(1, 0.1, 400)[:, None]
    asked = np.where(rng.random((25, 30)) < 0.2, rng.random((25, 30)), 0.0)
    term_ids = rng.permutation(30)
    lists = [np.flatnonzero(row) for row in dense]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(400) * 10), pa.array([x.tolist() for x in lists], pa.list_(pa.int32())), pa.array([dense[i][x].tolist() for i, x in enumerate(lists)], pa.list_(pa.float64()))],
        names=["doc_id", "positions", "weights"],
    )
    owner, position = np.nonzero(asked)
    best = scoring.Best(scoring.QueryBlock.of(owner, term_ids[position], asked[owner, position]), 5)
    for k in range(0, 400, 20):
        for block in scoring.document_blocks([batch.slice(k, 20)], term_ids):
            best.add(block)
    rows = best.rows().to_pandas()
    assert best.skipped > 100 and rows[rows.number == scoring.FIRST].doc_id.tolist() == [0, 10, 20, 30, 40]
    for q in np.unique(owner):
        scores = dense @ asked[q]
        want = [i for i in np.lexsort((np.arange(400), -scoring.rounded(scores)))[:5] if scores[i] > 0]
        got = rows[rows.number == q].sort_values("score", ascending=False)
        assert sorted(got.doc_id) == sorted(10 * np.array(want)) and np.allclose(got.score, np.sort(scores[want])[::-1])


@pytest.mark.parametrize("limit", [10_000, 1])
def test_rows_of_found_ids(corpus, monkeypatch, limit):
    from textlens.functions import rows

    monkeypatch.setattr(rows, "FILTERED_IDS", limit)
    wanted = corpus.filter("doc_id IN (3, 7)").select("doc_id")
    wanted = wanted.unionByName(wanted)
    assert sorted(r["doc_id"] for r in rows.only_rows_of(corpus, wanted).collect()) == [3, 7]


def test_memory_of_a_task_is_bounded(monkeypatch):
    """Few postings are added up at a time, with the same results, and ids do not hold on to the batches they came in."""
    rng = np.random.default_rng(3)
    weights = rng.random((50, 20)) * (rng.random((50, 20)) < 0.4)
    asked = rng.random((9, 20)) * (rng.random((9, 20)) < 0.5)
    at, owner = [np.flatnonzero(r) for r in weights], np.nonzero(asked)
    kind = pa.list_(pa.int32()), pa.list_(pa.float64())
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([a.tolist() for a in at], kind[0]), pa.array([r[a].tolist() for r, a in zip(weights, at)], kind[1])], names=["doc_id", "positions", "weights"])
    found = []
    for most in (1, 40, 1_000_000):
        monkeypatch.setattr(scoring, "POSTINGS_AT_ONCE", most)
        best = scoring.Best(scoring.QueryBlock.of(owner[0], owner[1], asked[owner]), 4)
        for block in scoring.document_blocks([batch.slice(0, 30), batch.slice(30)], np.arange(20)):
            best.add(block)
        assert sum(ids.get_total_buffer_size() for ids in best.ids) <= 50 * 8 + 64
        rows = best.rows().to_pydict()
        found.append(sorted(zip(rows["number"], rows["doc_id"], rows["score"])))
    assert found[0] == found[1] == found[2] and len(found[0]) == 9 * 4 + 4
