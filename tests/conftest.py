import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark):
    """Small texts with repeated words, stop words, equal rows and rows without known terms."""
    texts = [
        "the room was dirty dirty and the street noisy",
        "noisy street noisy room",
        "friendly staff great location",
        "great staff and a great breakfast",
        "room room room dirty bathroom",
        "friendly staff great location",
        "the and of",
        "zzz",
        "small bathroom noisy",
        "great great great great room",
    ]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, clean_text string")
