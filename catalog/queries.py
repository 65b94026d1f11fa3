"""One function per registered query: (spark, sf_dir) -> DataFrame. Floats are rounded to 6 places."""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import tables as t
from textlens.functions.constants import DEFAULT_QUERIES, ENGLISH_STOP_WORDS
from textlens.functions.text import (
    clean_text,
    excerpt,
    na_to_null,
    normalize_whitespace,
    to_number,
    word_tokens,
)
from textlens.functions.vectors import squared_norm, vector_values
from textlens.operators import report
from textlens.operators.classify import FITTED, fit_models_together, gradient_norms, top_terms
from textlens.operators.cluster import (
    assign,
    center_weights,
    cluster_costs,
    cluster_sizes,
    cluster_summary,
    lloyd_step,
    mean_centers,
    mean_weights,
    representatives,
    top_cluster_terms,
    with_distances,
)
from textlens.operators.curves import curve, curve_metrics
from textlens.operators.evaluate import (
    class_distribution,
    class_report,
    confusion_matrix,
    model_summary,
    overall_report,
    prevalence,
)
from textlens.operators.preparation import (
    binary_labels,
    cleaned_rows,
    row_funnel,
    three_class_labels,
)
from textlens.operators.sampling import exact_sample, stratified_split
from textlens.operators.scoring import search_vectors
from textlens.operators.search import query_summary, search_by_query, search_by_row, with_document_columns
from textlens.operators.selection import chi2_scores, class_weight_sums, select_k_best
from textlens.operators.silhouette import mean_silhouette, silhouette_values
from textlens.operators.tfidf import fit_tfidf, term_frequencies, term_statistics, with_terms
from textlens.plans.classification import ClassificationSettings, classify, fit_models, selection_sweep, split_and_vectorise
from textlens.plans.clustering import ClusteringSettings, best_k, cluster_complaints, cluster_sweep
from textlens.sources.index import build_index, index_documents
from textlens.sources.reviews import queries_from_list

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def r6(c: str):
    return F.round(c, 6).alias(c)


def cleaned(spark, sf_dir) -> DataFrame:
    return cleaned_rows(t.unscored_reviews(spark, sf_dir)).select("doc_id", "clean_text")


# Sources and columns


@query
def missing_values(spark, sf_dir):
    score = na_to_null("Reviewer_Score")
    return t.raw_reviews(spark, sf_dir).select(
        "doc_id", score.alias("score_text"), F.coalesce(score, F.lit("")).alias("filled")
    )


@query
def score_histogram(spark, sf_dir):
    return report.score_histogram(t.raw_reviews(spark, sf_dir))


@query
def normalized_text(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", normalize_whitespace("text").alias("normalized"))


@query
def cleaned_text(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", clean_text("text").alias("clean_text"))


@query
def blanked_placeholders(spark, sf_dir):
    return t.unscored_reviews(spark, sf_dir).select("doc_id", "Positive_Review", "Negative_Review")


@query
def text_columns(spark, sf_dir):
    return t.unscored_reviews(spark, sf_dir).select(
        "doc_id", "review_text", "negative_text", "positive_text"
    )


@query
def numeric_scores(spark, sf_dir):
    return t.raw_reviews(spark, sf_dir).select("doc_id", to_number("Reviewer_Score").alias("score"))


@query
def binary_sentiment(spark, sf_dir):
    return binary_labels(t.raw_reviews(spark, sf_dir)).select("doc_id", "label")


@query
def three_class_sentiment(spark, sf_dir):
    return three_class_labels(t.raw_reviews(spark, sf_dir)).select("doc_id", "label")


@query
def nonempty_complaints(spark, sf_dir):
    return t.unscored_reviews(spark, sf_dir).filter(F.length("negative_text") > 0).select(
        "doc_id", "negative_text"
    )


@query
def cleaned_complaints(spark, sf_dir):
    return cleaned_rows(t.unscored_reviews(spark, sf_dir), "negative_text").select("doc_id", "clean_text")


@query
def cleaned_praise(spark, sf_dir):
    return cleaned_rows(t.unscored_reviews(spark, sf_dir), "positive_text").select("doc_id", "clean_text")


@query
def text_excerpts(spark, sf_dir):
    return t.unscored_reviews(spark, sf_dir).select("doc_id", excerpt("review_text").alias("text_excerpt"))


@query
def display_columns(spark, sf_dir):
    return index_documents(cleaned_rows(t.reviews(spark, sf_dir)))


@query
def binary_row_funnel(spark, sf_dir):
    return row_funnel(t.reviews(spark, sf_dir))


@query
def complaint_row_funnel(spark, sf_dir):
    return row_funnel(t.reviews(spark, sf_dir), "negative_text", None)


# Sampling and splitting


@query
def seeded_sample(spark, sf_dir):
    return exact_sample(t.table(spark, sf_dir, "documents").select("doc_id", "lang"), t.SAMPLE_SIZE)


@query
def stratified_parts(spark, sf_dir):
    rows = cleaned_rows(binary_labels(t.reviews(spark, sf_dir))).select("doc_id", "label")
    return stratified_split(rows)[0]


@query
def three_class_part_sizes(spark, sf_dir):
    rows = cleaned_rows(three_class_labels(t.reviews(spark, sf_dir))).select("doc_id", "label")
    return stratified_split(rows)[0].groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("rows"))


# TF-IDF


@query
def text_words(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "doc_id", F.array_join(word_tokens("clean_text"), " ").alias("words")
    )


@query
def content_words(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "doc_id", F.array_join(word_tokens("clean_text", ENGLISH_STOP_WORDS), " ").alias("words")
    )


@query
def words_and_pairs(spark, sf_dir):
    return with_terms(cleaned(spark, sf_dir), t.SEARCH_BIGRAMS).select(
        "doc_id", F.array_join("terms", "|").alias("terms")
    )


@query
def document_term_counts(spark, sf_dir):
    return term_frequencies(cleaned(spark, sf_dir), t.SEARCH)


@query
def corpus_term_counts(spark, sf_dir):
    return term_statistics(cleaned(spark, sf_dir), t.SEARCH)


@query
def vocabulary(spark, sf_dir):
    model = fit_tfidf(cleaned(spark, sf_dir), t.SEARCH)
    return model.vocabulary(spark).withColumn("idf", F.round("idf", 6))


@query
def vocabulary_with_pairs(spark, sf_dir):
    model = fit_tfidf(cleaned(spark, sf_dir), t.SEARCH_BIGRAMS)
    return model.vocabulary(spark).withColumn("idf", F.round("idf", 6))


@query
def capped_vocabulary(spark, sf_dir):
    model = fit_tfidf(cleaned(spark, sf_dir), t.CAPPED)
    return model.vocabulary(spark).withColumn("idf", F.round("idf", 6))


@query
def tfidf_weights(spark, sf_dir):
    docs = cleaned(spark, sf_dir)
    model = fit_tfidf(docs, t.SEARCH)
    return model.postings(model.with_vectors(docs)).select("doc_id", "term_id", "term", r6("weight"))


@query
def tfidf_weights_with_pairs(spark, sf_dir):
    docs = cleaned(spark, sf_dir)
    model = fit_tfidf(docs, t.SEARCH_BIGRAMS)
    return model.postings(model.with_vectors(docs)).select("doc_id", "term_id", "term", r6("weight"))


@query
def vector_norms(spark, sf_dir):
    """A tiny vocabulary: most rows keep a zero vector."""
    docs = cleaned(spark, sf_dir)
    model = fit_tfidf(docs, t.TINY)
    return model.with_vectors(docs).select(
        "doc_id",
        F.size(vector_values("features")).alias("n_terms"),
        F.round(F.sqrt(squared_norm("features")), 6).alias("norm"),
    )


@query
def unseen_text_weights(spark, sf_dir):
    model = fit_tfidf(cleaned(spark, sf_dir), t.SEARCH)
    unseen = t.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("doc_id"), clean_text("text").alias("clean_text")
    )
    return model.postings(model.with_vectors(unseen)).select(
        F.col("doc_id").alias("item_id"), "term", r6("weight")
    )


# Selection and classifiers


def term_chi2(spark, sf_dir) -> DataFrame:
    data = split_and_vectorise(t.reviews(spark, sf_dir), t.CLASSIFY)
    sums = class_weight_sums(data.train).join(
        F.broadcast(data.model.positions(spark)), "position"
    )
    counts = spark.createDataFrame(list(data.train_counts.items()), "label string, n long")
    return chi2_scores(sums.select("term", "label", "weight_sum"), counts)


@query
def chi2_statistics(spark, sf_dir):
    return term_chi2(spark, sf_dir).select("term", r6("chi2"))


@query
def chi2_best_terms(spark, sf_dir):
    return select_k_best(term_chi2(spark, sf_dir), t.FEW).select("term", r6("chi2"))


def bayes(spark, sf_dir, settings: ClassificationSettings = t.CLASSIFY, k: int = 0):
    data = split_and_vectorise(t.reviews(spark, sf_dir), settings)
    return data, fit_models(data, k, ("naive_bayes",))["naive_bayes"]


@query
def naive_bayes_weights(spark, sf_dir):
    model = bayes(spark, sf_dir)[1].classifier
    rows = [
        (name, term, float(weight))
        for name, row in zip(model.classes, model.coefficients)
        for term, weight in zip(model.terms, row)
    ]
    return spark.createDataFrame(rows, "label string, term string, log_likelihood double").select(
        "label", "term", r6("log_likelihood")
    )


@query
def naive_bayes_predictions(spark, sf_dir):
    return bayes(spark, sf_dir)[1].predictions.select("doc_id", "label", "prediction", r6("target_score"))


@query
def naive_bayes_on_selected_terms(spark, sf_dir):
    predictions = bayes(spark, sf_dir, k=t.FEW)[1].predictions
    return predictions.select("doc_id", "label", "prediction", r6("target_score"))


@query
def naive_bayes_three_class(spark, sf_dir):
    predictions = bayes(spark, sf_dir, t.THREE_CLASS)[1].predictions
    return predictions.select("doc_id", "label", "prediction", r6("target_score"))


def ratio_weights(spark, model) -> DataFrame:
    """(class_label, term, weight): the log-likelihood ratio of both classes, a table as large as the vocabulary."""
    ratio = pd.DataFrame({"term": model.terms, "weight": model.coefficients[1] - model.coefficients[0]})
    weights = spark.createDataFrame(ratio, "term string, weight double")
    return weights.select(F.lit("positive").alias("class_label"), "term", "weight")


@query
def strongest_terms(spark, sf_dir):
    """Top terms on given weights: the log-likelihood ratio of the two classes."""
    model = bayes(spark, sf_dir)[1].classifier
    return top_terms(ratio_weights(spark, model), 2).select("class_label", "rank", "term", r6("weight"))


def fitted(spark, sf_dir, name: str, settings: ClassificationSettings = t.CLASSIFY):
    data = split_and_vectorise(t.reviews(spark, sf_dir), settings)
    return fit_models(data, t.SELECTED, (name,))[name]


@query
def logistic_regression_predictions(spark, sf_dir):
    return fitted(spark, sf_dir, "logistic_regression").predictions


@query
def linear_svm_predictions(spark, sf_dir):
    return fitted(spark, sf_dir, "linear_svm").predictions


@query
def linear_svm_three_class(spark, sf_dir):
    return fitted(spark, sf_dir, "linear_svm", t.THREE_CLASS).predictions


@query
def classifier_comparison(spark, sf_dir):
    settings = ClassificationSettings(sample_size=None, tfidf=t.LEARN, selection_k=t.SELECTED)
    return classify(t.reviews(spark, sf_dir), settings).summary()


@query
def classifier_top_features(spark, sf_dir):
    settings = ClassificationSettings(
        sample_size=None, tfidf=t.LEARN, selection_k=t.SELECTED, models=("linear_svm",)
    )
    return classify(t.reviews(spark, sf_dir), settings).top_features()


# Evaluation


@query
def label_distribution(spark, sf_dir):
    return class_distribution(three_class_labels(t.raw_reviews(spark, sf_dir)))


@query
def target_prevalence(spark, sf_dir):
    return prevalence(binary_labels(t.raw_reviews(spark, sf_dir))).select(r6("prevalence"))


@query
def confusion_cells(spark, sf_dir):
    return confusion_matrix(bayes(spark, sf_dir, t.THREE_CLASS)[1].predictions)


@query
def metrics_per_class(spark, sf_dir):
    confusion = confusion_matrix(bayes(spark, sf_dir, t.THREE_CLASS)[1].predictions)
    return class_report(confusion).select("label", r6("precision"), r6("recall"), r6("f1"), "support")


@query
def metrics_overall(spark, sf_dir):
    confusion = confusion_matrix(bayes(spark, sf_dir, t.THREE_CLASS)[1].predictions)
    result = overall_report(confusion)
    return result.select(*[c if c == "support" else r6(c) for c in result.columns])


def bayes_variants(spark, sf_dir) -> dict[str, DataFrame]:
    """Predictions with all terms and with the selected terms."""
    data = split_and_vectorise(t.reviews(spark, sf_dir), t.CLASSIFY)
    return {
        name: fit_models(data, k, ("naive_bayes",))["naive_bayes"].predictions
        for name, k in (("all_terms", 0), ("selected_terms", t.FEW))
    }


def rounded_scores(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("target_score", F.round("target_score", 6))


@query
def summary_of_models(spark, sf_dir):
    reports = {
        n: overall_report(confusion_matrix(p)) for n, p in bayes_variants(spark, sf_dir).items()
    }
    return model_summary(reports).select("model", *[r6(c) for c in report.METRICS])


@query
def precision_recall_points(spark, sf_dir):
    predictions = rounded_scores(bayes(spark, sf_dir)[1].predictions)
    return curve(predictions).precision_recall().select("point", r6("x"), r6("y"), "threshold")


@query
def roc_points(spark, sf_dir):
    predictions = rounded_scores(bayes(spark, sf_dir)[1].predictions)
    return curve(predictions).roc().select("point", r6("x"), r6("y"), "threshold")


@query
def curve_summary(spark, sf_dir):
    scored = {n: rounded_scores(p) for n, p in bayes_variants(spark, sf_dir).items()}
    result = curve_metrics(scored)
    return result.select("model", *[r6(c) for c in result.columns[1:]])


# Clusters: centers are the mean vectors of the languages


def complaints(spark, sf_dir):
    """Complaint rows with language, their TF-IDF model and vectors."""
    rows = cleaned_rows(t.unscored_reviews(spark, sf_dir), "negative_text").select(
        "doc_id", "negative_text", "clean_text"
    )
    model = fit_tfidf(rows, t.COMPLAINTS)
    vectors = model.with_vectors(rows.select("doc_id", "clean_text")).select("doc_id", "features").persist()
    return rows, model, vectors


def language_clusters(spark, sf_dir):
    rows, model, vectors = complaints(spark, sf_dir)
    languages = t.table(spark, sf_dir, "documents").select("doc_id", "lang")
    centers = mean_centers(
        vectors.join(languages, "doc_id"), "lang", t.languages(spark, sf_dir), len(model.terms)
    )
    return rows, model, vectors, centers


@query
def center_distances(spark, sf_dir):
    _, _, vectors, centers = language_clusters(spark, sf_dir)
    distances = with_distances(vectors, centers).select(
        "doc_id", F.posexplode("distances").alias("cluster", "distance")
    )
    return distances.select("doc_id", "cluster", r6("distance"))


@query
def nearest_centers(spark, sf_dir):
    _, _, vectors, centers = language_clusters(spark, sf_dir)
    return assign(vectors, centers).select("doc_id", "cluster", r6("distance"))


@query
def sizes_of_clusters(spark, sf_dir):
    _, _, vectors, centers = language_clusters(spark, sf_dir)
    return cluster_sizes(assign(vectors, centers), len(centers) + 1)


@query
def terms_of_clusters(spark, sf_dir):
    _, model, vectors, centers = language_clusters(spark, sf_dir)
    weights = mean_weights(assign(vectors, centers), model.positions(spark))
    return top_cluster_terms(weights).select("cluster", "rank", "term", r6("weight"))


@query
def cluster_representatives(spark, sf_dir):
    _, _, vectors, centers = language_clusters(spark, sf_dir)
    return representatives(assign(vectors, centers)).select(
        "cluster", "rank", "doc_id", r6("distance")
    )


def language_cluster_summary(spark, sf_dir) -> DataFrame:
    rows, model, vectors, centers = language_clusters(spark, sf_dir)
    assigned = assign(vectors, centers)
    return cluster_summary(
        cluster_sizes(assigned, len(centers) + 1),
        top_cluster_terms(mean_weights(assigned, model.positions(spark))),
        representatives(assigned),
        rows,
    )


@query
def summary_of_clusters(spark, sf_dir):
    return language_cluster_summary(spark, sf_dir)


@query
def silhouette_of_rows(spark, sf_dir):
    _, _, vectors, centers = language_clusters(spark, sf_dir)
    sample = exact_sample(assign(vectors, centers), 5000)
    return silhouette_values(sample, len(centers) + 1).select("doc_id", "cluster", r6("silhouette"))


@query
def silhouette_mean(spark, sf_dir):
    _, _, vectors, centers = language_clusters(spark, sf_dir)
    return mean_silhouette(assign(vectors, centers), len(centers) + 1).select(r6("silhouette_score"))


@query
def kmeans_summary(spark, sf_dir):
    settings = ClusteringSettings(sample_size=None, k=7, tfidf=t.COMPLAINTS)
    return cluster_complaints(t.unscored_reviews(spark, sf_dir), settings).summary()


@query
def kmeans_best_k(spark, sf_dir):
    settings = ClusteringSettings(sample_size=None, tfidf=t.COMPLAINTS)
    return best_k(cluster_sweep(t.unscored_reviews(spark, sf_dir), t.CLUSTER_COUNTS, settings)[0])


@query
def kmeans_step_centers(spark, sf_dir):
    """One Lloyd step from given centers: all weights of the means of the rows nearest to each."""
    _, model, vectors, centers = language_clusters(spark, sf_dir)
    moved, _ = lloyd_step(assign(vectors, centers), centers)
    weights = center_weights(spark, moved, model.position_terms)
    return weights.select("cluster", "term", r6("weight"))


@query
def kmeans_step_costs(spark, sf_dir):
    """Cost of each of the given centers and of the centers after a step, rows assigned anew."""
    _, _, vectors, centers = language_clusters(spark, sf_dir)
    assigned = assign(vectors, centers)
    moved, _ = lloyd_step(assigned, centers)
    costs = [cluster_costs(x).select(F.lit(step).alias("step"), "cluster", "size", r6("cost")) for step, x in enumerate((assigned, assign(vectors, moved)))]
    return costs[0].unionByName(costs[1])


@query
def kmeans_certificate(spark, sf_dir):
    """The fit itself has no SQL: its cost, the choice among restarts and that it has settled are worked out anew."""
    settings = ClusteringSettings(sample_size=None, k=7, tfidf=t.COMPLAINTS)
    return cluster_complaints(t.unscored_reviews(spark, sf_dir), settings).certificate()


@query
def best_of_given_sweep(spark, sf_dir):
    """The best k of a given table, with equal scores: mean lengths of the texts of each fifth of the documents."""
    documents = t.table(spark, sf_dir, "documents")
    table = documents.groupBy((F.col("doc_id") % 5 + 5).alias("k")).agg(F.round(F.avg("n_chars") / 1000, 0).alias("silhouette_score"), F.count("*").alias("n_documents"))
    return best_k(table)


@query
def linear_fit_certificates(spark, sf_dir):
    """Fits in steps have no SQL: the gradient at their weights, worked out with column expressions, has vanished."""
    data = split_and_vectorise(t.reviews(spark, sf_dir), t.CLASSIFY)
    training = data.training_data()
    found = None
    for model in fit_models_together(training, [(name, None) for name in FITTED]):
        row = gradient_norms(training, model).select(
            "model",
            F.lit(training.n_rows).cast("long").alias("n_train"),
            F.lit(len(training.terms)).cast("long").alias("n_terms"),
            (F.col("norm") <= 1.01e-4 * F.col("norm_at_zero")).alias("at_optimum"),
        )
        found = row if found is None else found.unionByName(row)
    return found


# Search


@query
def search_free_text(spark, sf_dir):
    found = search_by_query(cleaned(spark, sf_dir), t.SEARCH_TEXT, 10, t.SEARCH)
    return found.select("rank", r6("score"), "doc_id", "text")


@query
def search_like_document(spark, sf_dir):
    found = search_by_row(cleaned(spark, sf_dir), t.SEARCH_DOC, 10, t.SEARCH)
    return found.select("rank", r6("score"), "doc_id", "text")


def benchmark_search(spark, sf_dir):
    index = build_index(cleaned_rows(t.reviews(spark, sf_dir)), settings=t.SEARCH)
    return index, index.search(t.benchmark_queries(spark, sf_dir), 5)


@query
def search_many_queries(spark, sf_dir):
    index, found = benchmark_search(spark, sf_dir)
    columns = ["query_id", "query", "rank", r6("score"), "doc_id", "hotel_name", "reviewer_score", "text_excerpt"]
    return with_document_columns(found, index.documents).select(*columns)


@query
def search_named_queries(spark, sf_dir):
    """Strings as ids of documents and queries."""
    docs = cleaned(spark, sf_dir).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    queries = t.benchmark_queries(spark, sf_dir).withColumn("query_id", F.concat(F.lit("q"), F.col("query_id").cast("string")))
    model = fit_tfidf(docs, t.SEARCH)
    found = search_vectors(model.with_vectors(docs), model, queries, 5)
    return found.select("query_id", "query", "rank", r6("score"), "doc_id")


@query
def search_default_queries(spark, sf_dir):
    """Words that hardly occur here: most places are filled with score 0."""
    index = build_index(cleaned_rows(t.reviews(spark, sf_dir)), settings=t.SEARCH)
    found = index.search(queries_from_list(spark, DEFAULT_QUERIES), 5)
    return found.select("query_id", "query", "rank", r6("score"), "doc_id")


@query
def search_query_summary(spark, sf_dir):
    found = benchmark_search(spark, sf_dir)[1]
    return query_summary(found).select("query_id", "query", r6("top_score"), r6("mean_top_k_score"))


@query
def index_statistics(spark, sf_dir):
    return build_index(cleaned_rows(t.reviews(spark, sf_dir)), settings=t.SEARCH).statistics()


# Report tables


@query
def labelled_clusters(spark, sf_dir):
    """The main source of each language stands in for hand-made labels; empty clusters have none."""
    counts = t.table(spark, sf_dir, "documents").groupBy("lang", "source").count()
    main = counts.groupBy("lang").agg(
        F.min_by("source", F.struct(-F.col("count"), "source")).alias("rationale")
    )
    place = F.array_position(F.array(*map(F.lit, t.languages(spark, sf_dir))), F.col("lang")).cast("int") - 1
    labels = main.select(
        F.concat(F.lit("cluster_"), place.cast("string")).alias("cluster_id"),
        F.col("lang").alias("manual_label"),
        "rationale",
    )
    return report.labelled_cluster_summary(language_cluster_summary(spark, sf_dir), labels).select(
        "cluster_id", "size", "top_terms", "manual_label", "rationale"
    )


def sentiment_terms(spark, sf_dir) -> DataFrame:
    """Top terms with sentiment, rank and term; the negative list is shorter."""
    model = bayes(spark, sf_dir)[1].classifier
    best = top_terms(ratio_weights(spark, model), 2).filter("class_label = 'positive' OR rank <= 15")
    return best.select(F.col("class_label").alias("sentiment"), "rank", "term")


@query
def ranked_terms(spark, sf_dir):
    return sentiment_terms(spark, sf_dir)


@query
def terms_side_by_side(spark, sf_dir):
    return report.top_features_table(sentiment_terms(spark, sf_dir))


@query
def assessed_search_results(spark, sf_dir):
    """Labels of documents with the same number stand in for hand-made assessments of the queries."""
    notes = t.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("query_id"),
        F.when(F.col("quality") == 1, "relevant").otherwise("partly relevant").alias("assessment"),
    )
    found = benchmark_search(spark, sf_dir)[1].select("query_id", "query", "rank", r6("score"), "doc_id")
    return report.assessed_examples(found, notes)


def bayes_sweep(spark, sf_dir) -> DataFrame:
    return selection_sweep(t.reviews(spark, sf_dir), t.SWEEP, t.SWEPT).summary()


@query
def selection_grid(spark, sf_dir):
    """All models and all numbers of terms."""
    return selection_sweep(t.reviews(spark, sf_dir), t.SWEEP, t.GRID).summary()


@query
def selection_grid_best_terms(spark, sf_dir):
    """Ranked terms of the grid's best run."""
    return selection_sweep(t.reviews(spark, sf_dir), t.SWEEP, t.GRID).best_top_features()


@query
def selection_sweep_table(spark, sf_dir):
    return bayes_sweep(spark, sf_dir).select(
        "feature_selection_k", "model", *[r6(c) for c in report.METRICS]
    )


@query
def selection_sweep_best(spark, sf_dir):
    return report.best_run(bayes_sweep(spark, sf_dir)).select(
        "feature_selection_k", "model", r6("macro_f1"), r6("accuracy")
    )


@query
def selection_sweep_gain(spark, sf_dir):
    gain = report.delta_to_baseline(bayes_sweep(spark, sf_dir), "naive_bayes")
    return gain.select("model", "best_k", *[r6(c) for c in gain.columns[2:]])


@query
def model_results(spark, sf_dir):
    """The run without selection above the best run of the sweep."""
    sweep = selection_sweep(t.reviews(spark, sf_dir), t.SWEEP, t.SWEPT)
    best = report.best_run(sweep.summary()).head()["feature_selection_k"]
    runs = [sweep.results[k].summary() for k in (0, best)]
    table = report.model_results_table(*runs, best, report.BASELINE)
    return table.select("scenario", "model", *[r6(c) for c in report.METRICS])
