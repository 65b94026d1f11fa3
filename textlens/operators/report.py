"""Report tables: histogram, joins with hand-made notes, unions and best rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.functions.text import to_number

METRICS = ("macro_precision", "macro_recall", "macro_f1", "weighted_f1", "accuracy")


def score_histogram(reviews: DataFrame, score_col: str = "Reviewer_Score") -> DataFrame:
    """(reviewer_score, count), rising; only the score column is read, rows without a score are left out."""
    scores = reviews.select(to_number(score_col).alias("reviewer_score"))
    return (
        scores.filter(F.col("reviewer_score").isNotNull())
        .groupBy("reviewer_score")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("reviewer_score")
    )


def labelled_cluster_summary(summary: DataFrame, cluster_labels: DataFrame) -> DataFrame:
    """Cluster summary with the manual label and rationale of each cluster, null where there is none."""
    return summary.join(cluster_labels, "cluster_id", "left")


def top_features_table(top_features: DataFrame) -> DataFrame:
    """(rank, positive_term, negative_term) side by side; a shorter list leaves nulls, other
    sentiments are left out."""

    def side(sentiment: str) -> DataFrame:
        rows = top_features.filter(F.col("sentiment") == sentiment)
        return rows.select("rank", F.col("term").alias(f"{sentiment}_term"))

    return side("positive").join(side("negative"), "rank", "full").orderBy("rank")


def assessed_examples(examples: DataFrame, assessments: DataFrame, top: int = 3) -> DataFrame:
    """The first results of every query with the assessment of the query, null where there is none."""
    return (
        examples.filter(F.col("rank") <= top)
        .join(assessments, "query_id", "left")
        .orderBy("query_id", "rank")
    )


# Fixed value: the tag of the run with bigrams and without selection.
BASELINE = "baseline_bigram"


def model_results_table(baseline: DataFrame, best: DataFrame, best_k: int, baseline_scenario: str = BASELINE) -> DataFrame:
    """Both model summaries under each other, tagged with their scenario."""
    return (
        baseline.select(F.lit(baseline_scenario).alias("scenario"), "*")
        .unionByName(best.select(F.lit(f"feature_selection_k_{best_k}").alias("scenario"), "*"))
    )


def sweep_summary(runs: dict[int, DataFrame]) -> DataFrame:
    """Model summaries of all k under each other: model rising, macro F1 falling, k rising."""
    result = None
    for k, summary in runs.items():
        tagged = summary.select(F.lit(k).alias("feature_selection_k"), "model", *METRICS)
        result = tagged if result is None else result.unionByName(tagged)
    if result is None:
        raise ValueError("Give at least one k value.")
    return result.orderBy("model", F.round("macro_f1", 6).desc(), "feature_selection_k")


def model_runs(sweep: DataFrame, model: str = "linear_svm") -> DataFrame:
    return sweep.filter(F.col("model") == model).orderBy("feature_selection_k")


def best_run(sweep: DataFrame) -> DataFrame:
    """The row with the best macro F1 (ties: model, then the smaller k)."""
    return sweep.orderBy(F.round("macro_f1", 6).desc(), "model", "feature_selection_k").limit(1)


def delta_to_baseline(sweep: DataFrame, model: str = "linear_svm") -> DataFrame:
    """One row: the model's best run and its gain over the run without selection (k = 0)."""
    runs = sweep.filter(F.col("model") == model)
    if runs.filter(F.col("feature_selection_k") == 0).isEmpty():
        raise ValueError(f"The sweep holds no run of {model} with k = 0 to compare with.")
    return (
        runs.groupBy("model")
        .agg(
            F.max_by(F.struct("feature_selection_k", *METRICS), F.struct(F.round("macro_f1", 6), -F.col("feature_selection_k"))).alias("best"),
            F.max(F.when(F.col("feature_selection_k") == 0, F.col("macro_f1"))).alias("base_f1"),
            F.max(F.when(F.col("feature_selection_k") == 0, F.col("accuracy"))).alias("base_accuracy"),
        )
        .select(
            "model",
            F.col("best.feature_selection_k").alias("best_k"),
            F.col("base_f1").alias("baseline_macro_f1"),
            F.col("best.macro_f1").alias("best_macro_f1"),
            (F.col("best.macro_f1") - F.col("base_f1")).alias("delta_macro_f1"),
            (F.col("best.accuracy") - F.col("base_accuracy")).alias("delta_accuracy"),
        )
    )


def ranked_term_rows(term_lists: DataFrame) -> DataFrame:
    """(sentiment, rank, term) from (sentiment, terms): list places become ranks from 1."""
    return term_lists.select("sentiment", F.posexplode("terms").alias("pos", "term")).select(
        "sentiment", (F.col("pos") + 1).alias("rank"), "term"
    )
