"""Class counts, confusion matrix and the metrics derived from it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))


def prevalence(df: DataFrame, target: str = "negative", label: str = "label") -> DataFrame:
    """Share of rows with the target label."""
    return df.agg(F.avg((F.col(label) == target).cast("int")).alias("prevalence"))


def confusion_matrix(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(true_label, predicted_label, count) for every pair of labels seen, with zero cells."""
    counts = predictions.groupBy(
        F.col(label).alias("true_label"), F.col(prediction).alias("predicted_label")
    ).agg(F.count(F.lit(1)).alias("count"))
    labels = counts.agg(
        F.array_union(F.collect_set("true_label"), F.collect_set("predicted_label")).alias("labels")
    )
    cells = labels.select("labels", F.explode("labels").alias("true_label")).select(
        "true_label", F.explode("labels").alias("predicted_label")
    )
    return cells.join(counts, ["true_label", "predicted_label"], "left").select(
        "true_label", "predicted_label", F.coalesce("count", F.lit(0)).alias("count")
    )


def _ratio(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_report(confusion: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) per class; an empty denominator gives 0."""
    sides = confusion.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("true_label").alias("label"),
                    F.col("count").alias("actual"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("true_label") == F.col("predicted_label"), F.col("count"))
                    .otherwise(F.lit(0))
                    .alias("hits"),
                ),
                F.struct(
                    F.col("predicted_label").alias("label"),
                    F.lit(0).cast("long").alias("actual"),
                    F.col("count").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        )
    )
    totals = sides.groupBy("label").agg(
        F.sum("actual").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    return totals.select(
        "label",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def overall_report(confusion: DataFrame) -> DataFrame:
    """One row: macro and weighted averages and accuracy."""
    total = F.sum("support")

    def weighted(c: str):
        return F.sum(F.col(c) * F.col("support")) / total

    return class_report(confusion).agg(
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("weighted_f1"),
        # Hits over rows: every hit is counted in the recall of its class.
        weighted("recall").alias("accuracy"),
        total.alias("support"),
    )


def model_summary(reports: dict[str, DataFrame]) -> DataFrame:
    """(model, macro_precision, ..., accuracy), best macro F1 first."""
    tables = [
        report.select(
            F.lit(name).alias("model"),
            "macro_precision",
            "macro_recall",
            "macro_f1",
            "weighted_f1",
            "accuracy",
        )
        for name, report in reports.items()
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result.orderBy(F.desc("macro_f1"), "model")
