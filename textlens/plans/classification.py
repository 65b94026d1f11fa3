"""Train and compare sentiment classifiers."""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.operators.classify import MODELS, LinearClassifier, TrainingData, fit_models_together, top_model_terms
from textlens.operators.curves import curve_metrics, curve_points
from textlens.operators.evaluate import (
    class_distribution,
    class_report,
    confusion_matrix,
    model_summary,
    overall_report,
)
from textlens.operators.preparation import cleaned_rows, row_funnel, with_labels
from textlens.operators.report import best_run, sweep_summary
from textlens.operators.sampling import exact_sample, stratified_split
from textlens.operators.selection import best_positions, chi2_from_matrix
from textlens.operators.tfidf import TfidfModel, TfidfSettings, fit_tfidf, vectorizer_settings

# What is done to a text, for the report of a run.
CLEANING_STEPS = (
    "blank the placeholders of both review parts",
    "drop rows without the chosen text",
    "lower case",
    "keep letters only",
    "single spaces",
    "drop rows without letters",
)


@dataclass(frozen=True)
class ClassificationSettings:
    """``sample_size=None`` uses every row; ``selection_k=0`` keeps every term."""

    sample_size: int | None = 50_000
    label_scheme: str = "binary"
    text_column: str = "review_text"
    tfidf: TfidfSettings = TfidfSettings(min_df=5, max_df=0.9, max_features=50_000)
    selection_k: int = 0
    test_size: float = 0.2
    seed: int = 42
    models: tuple[str, ...] = MODELS


@dataclass
class TrainTest:
    """Split document vectors, fitted on the training part only. Persisted until ``release``."""

    model: TfidfModel
    vectors: DataFrame
    train_counts: dict[str, int]
    class_counts: dict[str, int]
    reviews: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.vectors.filter(~F.col("is_test"))

    @property
    def test(self) -> DataFrame:
        return self.vectors.filter("is_test")

    def training_data(self) -> TrainingData:
        return TrainingData(self.train, self.train_counts, self.model.position_terms)

    def release(self) -> None:
        self.vectors.unpersist()


def split_and_vectorise(reviews: DataFrame, settings: ClassificationSettings = ClassificationSettings()) -> TrainTest:
    """Sample, label, filter, split, and weigh the terms. Sampling comes before labels and filters.

    The split, the fit and the vectors each read the cleaned texts: these are kept until the vectors are. Both are read a few
    times in turn and so kept on disk; in memory they would fill the executors' heaps.
    """
    sampled = exact_sample(reviews, settings.sample_size, settings.seed)
    rows = cleaned_rows(with_labels(sampled, settings.label_scheme), settings.text_column)
    rows = rows.select("doc_id", "label", "clean_text").persist(StorageLevel.DISK_ONLY)
    try:
        split, counts = stratified_split(rows, settings.test_size, settings.seed)
        model = fit_tfidf(split.filter(~F.col("is_test")), settings.tfidf)
        vectors = model.with_vectors(split).select("doc_id", "label", "is_test", "features")
        vectors = vectors.persist(StorageLevel.DISK_ONLY)
        train_counts = {
            r["label"]: r["count"] for r in vectors.filter(~F.col("is_test")).groupBy("label").count().collect()
        }
    finally:
        rows.unpersist()
    return TrainTest(model, vectors, train_counts, counts, sampled)


@dataclass
class ModelRun:
    classifier: LinearClassifier
    predictions: DataFrame

    def confusion(self) -> DataFrame:
        return confusion_matrix(self.predictions)


def fit_grid(
    data: TrainTest, k_values: Iterable[int] = (0,), models: Iterable[str] = MODELS, target: str = "negative"
) -> dict[int, dict[str, ModelRun]]:
    """For every k: select terms on the training part, fit every model and predict the test part. All fits of all k share
    each pass over the training rows; a k is a mask on the same vectors. Every k that keeps all terms is the same run."""
    training, models = data.training_data(), list(models)
    terms = len(training.terms)
    kept: dict[int, list[int] | None] = {}
    for k in k_values:
        if not 0 < k < terms:
            kept[0] = None
        elif k not in kept:
            counts = [training.class_counts[c] for c in training.classes]
            kept[k] = best_positions(chi2_from_matrix(training.class_sums(), counts), training.terms, k)
    wanted = [(k, name) for k in kept for name in models]
    runs: dict[int, dict[str, ModelRun]] = {k: {} for k in kept}
    for (k, name), classifier in zip(wanted, fit_models_together(training, [(name, kept[k]) for k, name in wanted]), strict=True):
        predicted = classifier.predict(data.test, target).select("doc_id", "label", "prediction", "target_score")
        runs[k][name] = ModelRun(classifier, predicted)
    return {k: runs[k if 0 < k < terms else 0] for k in k_values}


def fit_models(
    data: TrainTest, selection_k: int = 0, models: Iterable[str] = MODELS, target: str = "negative"
) -> dict[str, ModelRun]:
    """`fit_grid` for one k."""
    return fit_grid(data, [selection_k], models, target)[selection_k]


@dataclass
class ClassificationResult:
    settings: ClassificationSettings
    data: TrainTest
    runs: dict[str, ModelRun]

    def summary(self) -> DataFrame:
        return model_summary({n: overall_report(r.confusion()) for n, r in self.runs.items()})

    def confusion_matrices(self) -> DataFrame:
        return _union({n: r.confusion() for n, r in self.runs.items()}, "model")

    def class_reports(self) -> DataFrame:
        return _union({n: class_report(r.confusion()) for n, r in self.runs.items()}, "model")

    def curve_metrics(self) -> DataFrame:
        return curve_metrics({n: r.predictions for n, r in self.runs.items()})

    def curve_points(self) -> DataFrame:
        return curve_points({n: r.predictions for n, r in self.runs.items()})

    def top_features(self, top_n: int = 20) -> DataFrame:
        """(model, sentiment, rank, term) of the models with term weights."""
        spark = self.data.vectors.sparkSession
        empty = spark.createDataFrame([], "model string, sentiment string, rank int, term string")
        tables = {
            n: top_model_terms(spark, r.classifier, top_n)
            for n, r in self.runs.items()
            if r.classifier.has_term_weights
        }
        if not tables:
            return empty
        return _union(tables, "model").withColumnRenamed("class_label", "sentiment").drop("weight")

    def class_distribution(self) -> DataFrame:
        return class_distribution(self.data.vectors)

    def funnel(self) -> DataFrame:
        return row_funnel(self.data.reviews, self.settings.text_column, self.settings.label_scheme)

    def as_json_row(self) -> DataFrame:
        """All results as one nested row, for a JSON file."""
        report = self.class_reports().groupBy("model").agg(
            F.array_sort(
                F.collect_list(F.struct("label", "precision", "recall", "f1", "support"))
            ).alias("classes")
        )
        matrix = self.confusion_matrices().groupBy("model").agg(
            F.array_sort(F.collect_list(F.struct("true_label", "predicted_label", "count"))).alias("confusion_matrix")
        )
        metrics = self.summary().join(report, "model").join(matrix, "model")
        per_model = metrics.agg(F.array_sort(F.collect_list(F.struct(*metrics.columns))).alias("metrics"))
        tfidf = self.settings.tfidf
        config = F.struct(
            F.lit(self.settings.sample_size).cast("long").alias("sample_size"),
            F.lit(self.settings.label_scheme).alias("label_scheme"),
            F.lit(self.settings.text_column).alias("text_column"),
            F.lit(tfidf.min_df).alias("min_df"),
            F.lit(tfidf.max_df).alias("max_df"),
            F.lit(tfidf.max_features).alias("max_features"),
            F.lit(tfidf.bigrams).alias("use_bigrams"),
            F.lit(self.settings.selection_k).alias("feature_selection_k"),
            F.lit(self.settings.test_size).alias("test_size"),
            F.lit(self.settings.seed).alias("random_state"),
        )
        counts = self.funnel().head()
        distribution = F.create_map(*[F.lit(v) for item in self.data.class_counts.items() for v in item])
        kept = ("rows_loaded", "rows_after_labeling", "rows_after_text_filter", "rows_after_cleaning")
        dataset = F.struct(*(F.lit(counts[c]).alias(c) for c in kept), distribution.alias("label_distribution"))
        dropped = {"by_label_filter": "dropped_by_label", "by_empty_selected_text": "dropped_by_empty_text", "by_empty_clean_text": "dropped_by_empty_clean_text"}
        train_rows = sum(self.data.train_counts.values())
        preprocessing = F.struct(
            F.lit(self.settings.text_column).alias("text_column"),
            F.lit(self.settings.label_scheme).alias("label_scheme"),
            F.array(*map(F.lit, CLEANING_STEPS)).alias("cleaning_steps"),
            vectorizer_settings(tfidf).alias("vectorizer"),
            F.struct(*(F.lit(counts[c]).alias(name) for name, c in dropped.items())).alias("rows_dropped"),
            F.lit(train_rows).cast("long").alias("train_rows"),
            F.lit(sum(self.data.class_counts.values()) - train_rows).cast("long").alias("test_rows"),
        )
        # (model, sentiment, terms in order of rank); models without term weights have none.
        listed = self.top_features().groupBy("model", "sentiment").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("terms"))
        listed = listed.select("model", "sentiment", F.transform("terms", lambda x: x["term"]).alias("terms"))
        spark = self.data.vectors.sparkSession
        # At most 20 terms a class and model.
        top = spark.createDataFrame([([tuple(r) for r in listed.orderBy("model", "sentiment").collect()],)], "top_features array<struct<model string, sentiment string, terms array<string>>>")
        both = per_model.withColumn("one", F.lit(1)).join(F.broadcast(top.withColumn("one", F.lit(1))), "one")
        return both.select(config.alias("config"), dataset.alias("dataset"), preprocessing.alias("preprocessing"), "metrics", "top_features")


def _union(tables: dict[str, DataFrame], tag: str) -> DataFrame:
    result = None
    for name, table in tables.items():
        tagged = table.select(F.lit(name).alias(tag), "*")
        result = tagged if result is None else result.unionByName(tagged)
    return result


def classify(reviews: DataFrame, settings: ClassificationSettings = ClassificationSettings()) -> ClassificationResult:
    """The whole classification of a table from ``with_text_columns``."""
    data = split_and_vectorise(reviews, settings)
    return ClassificationResult(settings, data, fit_models(data, settings.selection_k, settings.models))


@dataclass
class SelectionSweep:
    data: TrainTest
    results: dict[int, ClassificationResult]

    def summary(self) -> DataFrame:
        return sweep_summary({k: r.summary() for k, r in self.results.items()})

    def best_top_features(self, top_n: int = 20) -> DataFrame:
        """Ranked terms of the best run, empty if its model has no term weights."""
        best = best_run(self.summary()).head()
        result = self.results[best["feature_selection_k"]]
        return (
            result.top_features(top_n)
            .filter(F.col("model") == best["model"])
            .withColumn("feature_selection_k", F.lit(best["feature_selection_k"]))
        )


def selection_sweep(
    reviews: DataFrame,
    k_values: Iterable[int] = (0, 5000, 10_000, 20_000, 30_000),
    settings: ClassificationSettings = ClassificationSettings(),
) -> SelectionSweep:
    """The classification for several numbers of selected terms, over one set of vectors."""
    ks = list(k_values)
    if not ks:
        raise ValueError("Give at least one k value.")
    data = split_and_vectorise(reviews, settings)
    runs = fit_grid(data, ks, settings.models)
    return SelectionSweep(data, {k: ClassificationResult(settings, data, runs[k]) for k in ks})
