import pytest

from textlens.operators import report

METRICS = "macro_precision double, macro_recall double, macro_f1 double, weighted_f1 double, accuracy double"


def summary(spark, *rows):
    return spark.createDataFrame([(m, f, f, f, f, a) for m, f, a in rows], f"model string, {METRICS}")


def test_histogram(spark):
    rows = spark.createDataFrame([("9.6",), ("n/a",), ("2.5",), ("9.6",), (None,)], "Reviewer_Score string")
    assert [tuple(r) for r in report.score_histogram(rows).collect()] == [(2.5, 1), (9.6, 2)]


def test_joins(spark):
    clusters = spark.createDataFrame([("cluster_0", 3), ("cluster_1", 0)], "cluster_id string, size long")
    labels = spark.createDataFrame([("cluster_0", "noise", "words")], "cluster_id string, manual_label string, rationale string")
    got = report.labelled_cluster_summary(clusters, labels).orderBy("cluster_id").collect()
    assert [tuple(r) for r in got] == [("cluster_0", 3, "noise", "words"), ("cluster_1", 0, None, None)]
    terms = spark.createDataFrame(
        [("positive", ["a", "b"]), ("negative", ["x"]), ("neutral", ["n"])], "sentiment string, terms array<string>"
    )
    ranked = report.ranked_term_rows(terms)
    assert ranked.count() == 4
    assert [tuple(r) for r in report.top_features_table(ranked).collect()] == [(1, "a", "x"), (2, "b", None)]
    examples = spark.createDataFrame([(q, r) for q in (2, 1) for r in (4, 3, 1, 2)], "query_id int, rank int")
    notes = spark.createDataFrame([(1, "relevant")], "query_id int, assessment string")
    got = [tuple(r) for r in report.assessed_examples(examples, notes).collect()]
    assert got == [(1, r, "relevant") for r in (1, 2, 3)] + [(2, r, None) for r in (1, 2, 3)]


def test_sweep(spark):
    runs = {
        0: summary(spark, ("linear_svm", 0.80, 0.95), ("naive_bayes", 0.60, 0.90)),
        5000: summary(spark, ("linear_svm", 0.81, 0.96), ("naive_bayes", 0.60, 0.91)),
    }
    sweep = report.sweep_summary(runs)
    assert [(r[1], r[0]) for r in sweep.collect()] == [
        ("linear_svm", 5000), ("linear_svm", 0), ("naive_bayes", 0), ("naive_bayes", 5000),
    ]
    assert [r[0] for r in report.model_runs(sweep).collect()] == [0, 5000]
    best = report.best_run(sweep).head()
    assert (best["feature_selection_k"], best["model"]) == (5000, "linear_svm")
    gain = report.delta_to_baseline(sweep).head()
    assert gain["best_k"] == 5000 and gain["delta_macro_f1"] == pytest.approx(0.01)
    assert report.delta_to_baseline(sweep, "naive_bayes").head()["best_k"] == 0
    with pytest.raises(ValueError, match="k = 0"):
        report.delta_to_baseline(report.sweep_summary({5000: runs[5000]}))
    with pytest.raises(ValueError):
        report.sweep_summary({})
    table = report.model_results_table(runs[0], runs[5000], 5000).collect()
    assert [r["scenario"] for r in table] == ["baseline_bigram"] * 2 + ["feature_selection_k_5000"] * 2
