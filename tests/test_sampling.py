import hashlib

import pytest
from pyspark.sql import functions as F

from textlens.operators import sampling
from textlens.operators.sampling import exact_sample, split_quotas, stratified_split


def key(i, seed=42):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


@pytest.mark.parametrize("limit", [10_000, 7])
@pytest.mark.parametrize("n", [1, 50, 999, 1000, 5000, None, 0])
def test_exact_sample(spark, monkeypatch, n, limit):
    monkeypatch.setattr(sampling, "KEYS_ON_DRIVER", limit)
    rows = spark.range(1000).select(F.col("id").alias("doc_id"))
    got = sorted(r[0] for r in exact_sample(rows, n).collect())
    size = 1000 if n is None else n
    assert got == sorted(sorted(range(1000), key=key)[:size])
    assert got == sorted(r[0] for r in exact_sample(rows.repartition(7), n).collect())


@pytest.mark.parametrize(
    "counts, expected",
    [
        # Class sizes and test part of recorded runs.
        ({"negative": 30623, "positive": 335365}, {"negative": 6125, "positive": 67073}),
        ({"negative": 3017, "positive": 32502}, {"negative": 603, "positive": 6501}),
        ({"negative": 282, "positive": 3232}, {"negative": 56, "positive": 647}),
        ({"negative": 272, "positive": 1902}, {"negative": 54, "positive": 381}),
    ],
)
def test_recorded_quotas(counts, expected):
    assert split_quotas(counts) == expected


def test_quota_errors():
    with pytest.raises(ValueError):
        split_quotas({"a": 1, "b": 10})
    with pytest.raises(ValueError):
        split_quotas({"a": 2, "b": 2, "c": 2, "d": 2})


@pytest.mark.parametrize("limit", [10_000, 5])
def test_split(spark, monkeypatch, limit):
    monkeypatch.setattr(sampling, "KEYS_ON_DRIVER", limit)
    label = F.when(F.col("id") % 10 == 0, "a").when(F.col("id") % 3 == 0, "b").otherwise("c")
    rows = spark.range(501).select(F.col("id").alias("doc_id"), label.alias("label"))
    split, counts = stratified_split(rows)
    quotas = split_quotas(counts)
    assert sum(quotas.values()) == 101
    members = {}
    for r in rows.collect():
        members.setdefault(r["label"], []).append(r["doc_id"])
    expected = {i for c, ids in members.items() for i in sorted(ids, key=key)[: quotas[c]]}
    assert {r["doc_id"] for r in split.filter("is_test").collect()} == expected


def test_sample_is_a_narrow_filter(spark):
    plan = exact_sample(spark.range(1000).withColumnRenamed("id", "doc_id"), 10)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [10_000, 50])
def test_equal_and_missing_ids(spark, monkeypatch, limit):
    """Many rows with one id or none: sizes stay exact, and rows that differ are drawn alike every time."""
    monkeypatch.setattr(sampling, "KEYS_ON_DRIVER", limit)
    rows = spark.range(20_000).select(
        F.when(F.col("id") < 15_000, F.lit(7)).when(F.col("id") < 18_000, None).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("text"),
    )
    for n in (1, 3_000, 9_000, 16_000, 19_999):
        one, other = (exact_sample(r, n).groupBy("doc_id", "text").count().collect() for r in (rows, rows.repartition(5)))
        assert sum(r["count"] for r in one) == n
        assert sorted(map(str, one)) == sorted(map(str, other))
    split, counts = stratified_split(rows.withColumn("label", F.when(F.col("text") < 0, "a").otherwise("b")))
    got = {r["label"]: r["count"] for r in split.filter("is_test").groupBy("label").count().collect()}
    assert got == split_quotas(counts) and split.count() == 20_000
