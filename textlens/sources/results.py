"""Result files: CSV and JSON written by Spark, and read back for comparisons."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
