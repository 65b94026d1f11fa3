"""Input tables and the settings shared by queries and SQL."""

from pyspark.sql import DataFrame, SparkSession

from textlens.operators.tfidf import TfidfSettings
from textlens.plans.classification import ClassificationSettings
from textlens.sources.reviews import reviews_from_documents, spread, with_text_columns

SEARCH = TfidfSettings(min_df=3, max_df=0.9, max_features=30_000)
SEARCH_BIGRAMS = TfidfSettings(min_df=3, max_df=0.9, max_features=30_000, bigrams=True)
CAPPED = TfidfSettings(min_df=3, max_df=0.9, max_features=500)
TINY = TfidfSettings(min_df=3, max_df=0.1, max_features=40)
LEARN = TfidfSettings(min_df=5, max_df=0.9, max_features=50_000)
PAIRS = TfidfSettings(min_df=5, max_df=0.9, max_features=50_000, bigrams=True)
COMPLAINTS = TfidfSettings(min_df=5, max_df=0.9, max_features=30_000)
CLASSIFY = ClassificationSettings(sample_size=None, tfidf=LEARN, models=("naive_bayes",))
THREE_CLASS = ClassificationSettings(
    sample_size=None, tfidf=LEARN, label_scheme="three_class", models=("naive_bayes",)
)
SWEPT = ClassificationSettings(sample_size=None, tfidf=PAIRS, models=("naive_bayes",))
GRID = ClassificationSettings(sample_size=None, tfidf=PAIRS)
SAMPLE_SIZE = 150
SELECTED = 20_000
# The least number of selected terms of the sweep.
FEW = 5000
SWEEP = (0, 5000, 10_000, 20_000, 30_000)
CLUSTER_COUNTS = (5, 6, 7, 8, 9)
SEARCH_TEXT = "there and onesen in the thing, nounce of ouen reding whst"
SEARCH_DOC = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_from_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review rows with score and text columns."""
    return with_text_columns(raw_reviews(spark, sf_dir))


def unscored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review rows without the score: no join with the labels."""
    return with_text_columns(reviews_from_documents(documents(spark, sf_dir)))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").selectExpr("item_id AS query_id", "text AS query")


def languages(spark: SparkSession, sf_dir: str) -> list[str]:
    """The languages of the documents in order; their numbers are cluster numbers."""
    rows = table(spark, sf_dir, "documents").select("lang").filter("lang IS NOT NULL").distinct().collect()
    return sorted(r["lang"] for r in rows)
