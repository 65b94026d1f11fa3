"""Labels, row filters and row counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.functions.text import clean_text, has_letters, to_number
from textlens.sources.reviews import TEXT_COLUMNS, require_columns


def binary_label(score: Column, negative_threshold: float = 5.0, positive_threshold: float = 8.0) -> Column:
    """Label by score; null between the bounds and for a missing score."""
    return F.when(score <= negative_threshold, "negative").when(
        (score >= positive_threshold) & ~F.isnan(score), "positive"
    )


def binary_labels(
    df: DataFrame,
    score_col: str = "Reviewer_Score",
    negative_threshold: float = 5.0,
    positive_threshold: float = 8.0,
) -> DataFrame:
    """Add ``label``; rows between the bounds and rows without a score are dropped."""
    require_columns(df, [score_col])
    label = binary_label(to_number(score_col), negative_threshold, positive_threshold)
    return df.withColumn("label", label).filter(F.col("label").isNotNull())


def three_class_labels(
    df: DataFrame,
    score_col: str = "Reviewer_Score",
    negative_threshold: float = 5.0,
    positive_threshold: float = 8.0,
) -> DataFrame:
    """Add ``label``; rows between the bounds and rows without a score are neutral."""
    require_columns(df, [score_col])
    label = binary_label(to_number(score_col), negative_threshold, positive_threshold)
    return df.withColumn("label", F.coalesce(label, F.lit("neutral")))


def with_labels(df: DataFrame, scheme: str = "binary") -> DataFrame:
    if scheme == "binary":
        return binary_labels(df)
    if scheme == "three_class":
        return three_class_labels(df)
    raise ValueError("The label scheme is 'binary' or 'three_class'.")


def check_text_column(text_column: str) -> str:
    if text_column not in TEXT_COLUMNS:
        raise ValueError(f"The text column is one of {', '.join(TEXT_COLUMNS)}.")
    return text_column


def cleaned_rows(df: DataFrame, text_column: str = "review_text") -> DataFrame:
    """Add ``clean_text`` of the chosen text column and drop the rows with no letters left.

    An empty text has no letters either, so one test of the cleaned text does for both. It is made on an array of one
    text that is then unpacked: a plain filter would be moved below the cleaning with a copy of all its expressions.
    """
    require_columns(df, [check_text_column(text_column)])
    kept = F.filter(F.array(clean_text(text_column)), lambda t: t != "")
    return df.withColumn("clean_text", F.explode(kept))


def row_funnel(df: DataFrame, text_column: str = "review_text", scheme: str | None = "binary") -> DataFrame:
    """One row of counts after every filter and of the rows each filter drops, in one pass."""
    check_text_column(text_column)
    if scheme == "binary":
        labelled = binary_label(to_number("Reviewer_Score")).isNotNull()
    else:
        labelled = F.lit(True)
    flags = df.select(
        labelled.alias("labelled"),
        (F.length(text_column) > 0).alias("has_text"),
        has_letters(text_column).alias("has_letters"),
    )
    counts = flags.agg(
        F.count(F.lit(1)).alias("rows_loaded"),
        F.count_if("labelled").alias("rows_after_labeling"),
        F.count_if(F.col("labelled") & F.col("has_text")).alias("rows_after_text_filter"),
        F.count_if(F.col("labelled") & F.col("has_text") & F.col("has_letters")).alias(
            "rows_after_cleaning"
        ),
    )
    return counts.withColumns(
        {
            "dropped_by_label": F.col("rows_loaded") - F.col("rows_after_labeling"),
            "dropped_by_empty_text": F.col("rows_after_labeling") - F.col("rows_after_text_filter"),
            "dropped_by_empty_clean_text": F.col("rows_after_text_filter")
            - F.col("rows_after_cleaning"),
        }
    )
