import json

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import tables as t
from textlens.operators.tfidf import TfidfSettings
from textlens.plans.classification import ClassificationSettings, classify, selection_sweep, split_and_vectorise
from textlens.plans.clustering import ClusteringSettings, best_k, cluster_sweep
from textlens.plans.retrieval import RetrievalSettings, find_similar, run_queries
from textlens.sources.results import write_json

SMALL = TfidfSettings(min_df=3, max_df=0.9, max_features=400)


def test_classification_sweep(spark, sf_dir, tmp_path):
    settings = ClassificationSettings(sample_size=150, tfidf=SMALL)
    sweep = selection_sweep(t.reviews(spark, sf_dir), (0, 50, 10_000), settings)
    table = sweep.summary().collect()
    assert len(table) == 9
    # More terms asked for than there are: the same as no selection.
    by_run = {(r["feature_selection_k"], r["model"]): tuple(r)[2:] for r in table}
    assert all(by_run[0, m] == by_run[10_000, m] for m in settings.models)
    assert {r["sentiment"] for r in sweep.best_top_features(5).collect()} <= {"positive", "negative"}
    result = sweep.results[50]
    assert result.funnel().head()["rows_loaded"] == 150
    assert result.curve_metrics().count() == 3
    assert result.curve_points().select("curve", "model").distinct().count() == 6
    write_json(result.as_json_row(), str(tmp_path / "result"))
    file = next((tmp_path / "result").glob("*.json"))
    tree = json.loads(file.read_text())
    assert tree["config"]["max_features"] == 400 and len(tree["metrics"]) == 3
    counts, report = tree["dataset"], tree["preprocessing"]
    assert counts["rows_loaded"] == 150 and sum(counts["label_distribution"].values()) == counts["rows_after_cleaning"]
    assert report["train_rows"] + report["test_rows"] == counts["rows_after_cleaning"]
    assert report["rows_dropped"]["by_label_filter"] == counts["rows_loaded"] - counts["rows_after_labeling"]
    assert report["vectorizer"]["method"] == "tfidf" and report["vectorizer"]["stop_words"] == "english"
    top = {(x["model"], x["sentiment"]): x["terms"] for x in tree["top_features"]}
    assert set(top) == {(m, c) for m in ("linear_svm", "logistic_regression") for c in ("negative", "positive")}
    assert all(len(x) == 20 for x in top.values())
    sweep.data.release()


def test_a_text_is_cleaned_once_and_not_kept(spark):
    """Split, term counts and vectors share the cleaned texts; only the vectors stay, also after a fit that fails."""
    words = ("clean", "dirty", "quiet", "noisy", "kind", "rude")
    rows = [(i, "9.6" if i % 2 else "3.3", f"{words[i % 6]} {words[(i * 5 + 1) % 6]} room {i}") for i in range(60)]
    texts = spark.createDataFrame(rows, "doc_id long, Reviewer_Score string, review_text string").repartition(3)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    kept = spark.sparkContext._jsc.getPersistentRDDs
    reviews, before = texts.mapInArrow(counted, texts.schema), len(kept())
    data = split_and_vectorise(reviews, ClassificationSettings(sample_size=None, tfidf=TfidfSettings(1, 1.0, 100)))
    assert data.vectors.count() == 60 and sum(data.train_counts.values()) == 48
    assert read.value == 60
    assert len(kept()) == before + 1
    data.release()
    with pytest.raises(ValueError, match="No terms"):
        split_and_vectorise(reviews, ClassificationSettings(sample_size=None, tfidf=TfidfSettings(48, 1.0, 100, stop_words=("room",))))
    assert len(kept()) == before


def test_three_classes(spark, sf_dir):
    settings = ClassificationSettings(sample_size=None, label_scheme="three_class", tfidf=SMALL, text_column="negative_text")
    result = classify(t.reviews(spark, sf_dir), settings)
    assert result.confusion_matrices().count() == 27
    assert result.top_features(4).filter("model = 'linear_svm'").count() == 12
    with pytest.raises(ValueError):
        classify(t.reviews(spark, sf_dir), ClassificationSettings(label_scheme="other"))


def test_cluster_sweep(spark, sf_dir, tmp_path):
    settings = ClusteringSettings(tfidf=SMALL, restarts=2)
    table, results = cluster_sweep(t.unscored_reviews(spark, sf_dir), (3, 2), settings)
    rows = table.collect()
    assert [r["k"] for r in rows] == [2, 3] and all(-1 <= r["silhouette_score"] <= 1 for r in rows)
    assert best_k(table).head()["silhouette_score"] == max(r["silhouette_score"] for r in rows)
    assert results[3].summary().count() == 3
    write_json(results[3].as_json_row(), str(tmp_path / "clusters"))
    tree = json.loads(next((tmp_path / "clusters").glob("*.json")).read_text())
    assert [c["cluster_id"] for c in tree["clusters"]] == ["cluster_0", "cluster_1", "cluster_2"]
    assert tree["n_documents"] == sum(c["size"] for c in tree["clusters"])
    assert all(len(c["top_terms"]) == 12 for c in tree["clusters"])
    assert tree["dataset"]["rows_after_cleaning"] == tree["dataset"]["n_documents"] == tree["n_documents"]
    assert tree["preprocessing"]["vectorizer"]["ngram_range"] == [1, 1] and len(tree["preprocessing"]["cleaning_steps"]) == 6
    row = results[3].certificate().head()
    assert row["cost_confirmed"] and row["least_of_restarts"] and row["restarts"] == 2


def test_retrieval(spark, sf_dir):
    settings = RetrievalSettings(sample_size=100, tfidf=SMALL, top_k=3)
    batch = run_queries(t.reviews(spark, sf_dir), ["then there", "nothing like it"], settings)
    assert batch.examples().count() == 6 and batch.summary().count() == 2
    assert batch.index.statistics().head()["n_documents"] <= 100
    about = batch.metadata().head()
    assert about["rows_loaded"] == 100 and about["rows_after_cleaning"] == about["matrix_shape"][0]
    assert about["n_queries"] == 2
    assert find_similar(t.reviews(spark, sf_dir), query="then", settings=settings).count() == 3
    with pytest.raises(ValueError):
        find_similar(t.reviews(spark, sf_dir))


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["rank", "score", "doc_id", "text"] and result.count() == 10


def test_registry_and_sql_fit_together(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    assert set(oracle_sql()) <= set(queries())
    for name in ("text_columns", "stratified_parts", "vocabulary_with_pairs", "roc_points"):
        got = queries()[name](spark, sf_dir)
        want = con.execute(oracle_sql()[name]).fetchall()
        columns = [d[0] for d in con.description]
        assert sorted(got.columns) == sorted(columns)
        assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want))
