import pytest
from pyspark.sql import functions as F

import brute
from textlens.functions.constants import ENGLISH_STOP_WORDS
from textlens.operators.tfidf import TfidfSettings, fit_tfidf, term_frequencies, term_statistics

CASES = [
    dict(min_df=1, max_df=1.0, max_features=100),
    dict(min_df=2, max_df=0.5, max_features=100),
    dict(min_df=1, max_df=1.0, max_features=3),
    dict(min_df=1, max_df=1.0, max_features=6, bigrams=True),
    dict(min_df=1, max_df=0.3, max_features=100, bigrams=True),
]


def texts_of(df):
    return {r["doc_id"]: r["clean_text"] for r in df.collect()}


@pytest.mark.parametrize("case", CASES)
def test_vocabulary_and_weights(spark, corpus, case):
    texts = texts_of(corpus)
    want = brute.vocabulary(list(texts.values()), ENGLISH_STOP_WORDS, **case)
    model = fit_tfidf(corpus.repartition(3), TfidfSettings(**case))
    assert model.n_docs == len(texts)
    got = {r["term"]: (r["df"], r["ctf"], pytest.approx(r["idf"])) for r in model.vocabulary(spark).collect()}
    assert got == want and model.terms == list(want)
    vectors = model.with_vectors(corpus)
    assert vectors.count() == len(texts)
    found = {}
    for r in model.postings(vectors).collect():
        assert model.terms[r["term_id"]] == r["term"]
        found[r["doc_id"], r["term"]] = pytest.approx(r["weight"])
    bigrams = case.get("bigrams", False)
    assert found == {
        (d, t): w for d, x in texts.items() for t, w in brute.weights(x, want, ENGLISH_STOP_WORDS, bigrams).items()
    }


def test_pairs_bridge_stop_words(spark):
    docs = spark.createDataFrame([(1, "did not like the room"), (2, "did t like room")], "doc_id long, clean_text string")
    model = fit_tfidf(docs, TfidfSettings(1, 1.0, 100, True, ("not", "the")))
    assert model.terms == ["did", "did like", "like", "like room", "room"]


def test_counts(spark, corpus):
    settings = TfidfSettings(1, 1.0, 100)
    tf = {(r["doc_id"], r["term"]): r["tf"] for r in term_frequencies(corpus, settings).collect()}
    assert tf[0, "dirty"] == 2 and tf[9, "great"] == 4 and (6, "the") not in tf
    stats = {r["term"]: (r["df"], r["ctf"]) for r in term_statistics(corpus, settings).collect()}
    assert stats[None] == (10, 0) and stats["great"] == (4, 8)
    model = fit_tfidf(corpus, settings)
    from textlens.functions.vectors import vector_values

    total = model.with_counts(corpus).select(F.explode(vector_values("counts")).alias("n")).agg(F.sum("n")).head()[0]
    assert total == sum(tf.values())


def test_errors(spark, corpus):
    with pytest.raises(ValueError, match="min_df"):
        fit_tfidf(corpus, TfidfSettings(min_df=6, max_df=0.5))
    with pytest.raises(ValueError, match="No terms"):
        fit_tfidf(corpus, TfidfSettings(min_df=9, max_df=1.0))


def test_fit_moves_terms_only(spark, corpus):
    """The fit has one exchange (by term), and document vectors need none."""
    settings = TfidfSettings(1, 1.0, 100)
    plan = term_statistics(corpus, settings)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    plan = fit_tfidf(corpus, settings).with_vectors(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_term_statistics_explode_plain_strings(spark):
    """Counts of repeated, missing (not counted) and empty texts; no struct is made for a word."""
    rows = spark.createDataFrame([(1, "room room dirty"), (1, "room room dirty"), (2, ""), (3, None), (4, "zz room")], "doc_id long, clean_text string")
    stats = term_statistics(rows, TfidfSettings(stop_words=()))
    assert {r["term"]: (r["df"], r["ctf"]) for r in stats.collect()} == {None: (4, 0), "room": (3, 5), "dirty": (2, 2), "zz": (1, 1)}
    assert "struct" not in stats._jdf.queryExecution().optimizedPlan().toString()


def test_terms_are_counted_by_part_of_text(spark, monkeypatch):
    """Words end at spaces and with their text, also where parts of a slice of texts are counted one by one; no word is a row."""
    import pyarrow as pa

    from textlens.functions import words

    texts = ["x", None, "  room a  room", "", "the bed ", "\u00e9 caf\u00e9 \u00e9\u00e9", "bed room the bed room", "b"]
    whole = pa.array(texts).slice(1, 6)
    pieces = {}
    for size in (1, 12, 1 << 20):
        monkeypatch.setattr(words, "PART_BYTES", size)
        pieces[size] = [w for part in words.text_parts(whole) for w in zip(*(x.tolist() for x in (words.split_words(part)[0], words.split_words(part)[1].to_numpy(zero_copy_only=False))))]
        assert [w for _, w in pieces[size]] == [w for t in texts[1:7] if t for w in t.split(" ") if len(w) > 1]
    assert [r for r, _ in pieces[1 << 20]] == [0, 0, 2, 2, 3, 3, 4, 4, 4, 4, 4]
    found = words.term_counts(whole.drop_null(), ("the",), True).to_pydict()
    counts = {t: (d, c) for t, d, c in zip(found["term"], found["df"], found["ctf"])}
    assert counts[None] == (5, 0) and counts["bed room"] == (1, 2) and counts["room bed"] == (1, 1) and counts["room room"] == (1, 1) and counts["bed"] == (2, 3)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, clean_text string").repartition(3)
    settings = TfidfSettings(stop_words=("the",), bigrams=True)
    stats = term_statistics(rows, settings)
    assert {r["term"]: (r["df"], r["ctf"]) for r in stats.collect()} == {**counts, None: (7, 0)}
    assert "Generate" not in stats._jdf.queryExecution().optimizedPlan().toString()


def test_vectors_of_words_need_no_word_tests(spark, corpus):
    """Stop words are looked up like all words that the vocabulary lacks; a vocabulary that has some drops them as before."""
    from textlens.operators.tfidf import TfidfModel

    model = fit_tfidf(corpus, TfidfSettings(1, 1.0, 100))
    assert "lambda" not in model.with_vectors(corpus)._jdf.queryExecution().optimizedPlan().toString()
    odd = TfidfModel(TfidfSettings(1, 1.0, 100), 10, ["room", "the"], [4, 2], [7, 3])
    assert {r["term"] for r in odd.postings(odd.with_vectors(corpus)).collect()} == {"room"}
