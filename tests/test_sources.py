import random

import pytest
from pyspark.sql import functions as F

from textlens.operators.preparation import binary_labels, cleaned_rows, row_funnel, three_class_labels
from textlens.operators.sampling import exact_sample
from textlens.operators.tfidf import TfidfSettings
from textlens.plans.retrieval import RetrievalSettings, index_reviews
from textlens.sources import csv_records
from textlens.sources.index import load_index, save_index
from textlens.sources.results import read_csv, read_json, write_csv, write_json
from textlens.sources.reviews import (
    queries_from_list,
    read_queries,
    read_reviews_csv,
    reviews_from_documents,
    with_text_columns,
)

CSV = (
    "Hotel_Name,Reviewer_Score,Positive_Review,Negative_Review\n"
    'A,9.6,"He said ""no""\nand left",No Negative\n'
    "B,n/a,NA,n/a\n"
    "C,5.0, No Positive ,Dirty  room\n"
    "D,8.0,10/10 !!!,Nothing\n"
    "E,6.5,fine,noisy\n"
)


@pytest.fixture()
def reviews(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(CSV)
    return with_text_columns(read_reviews_csv(spark, str(path)))


def test_csv(reviews):
    rows = {r["Hotel_Name"]: r for r in reviews.collect()}
    assert len(rows) == 5 and len({r["doc_id"] for r in rows.values()}) == 5
    assert rows["A"]["positive_text"] == 'He said "no" and left'
    assert rows["A"]["Positive_Review"] == 'He said "no"\nand left'
    assert rows["B"]["Reviewer_Score"] is None and rows["B"]["review_text"] == ""
    assert rows["C"]["review_text"] == "Dirty room" and rows["C"]["negative_text"] == "Dirty room"
    assert rows["D"]["negative_text"] == ""


def _odd_csv(rng, rows):
    """Records with line breaks, doubled quotes, separators, empty and long fields, CRLF inside quotes."""
    out = ["id,a b,c\n"]
    for i in range(rows):
        field = rng.choice(['plain', '', '"with\nbreak"', '"two ""quotes"" and\n\n""more"""', '",;\r\n"', '"' + "long line\n" * rng.randrange(1, 30) + '"', '""', '" "'])
        out.append(f"{i},{field},{rng.choice(['x', '', '"y' + chr(10) + 'z"'])}\n")
        if rng.random() < 0.1:
            out.append("\n")
    return "".join(out)


@pytest.mark.parametrize("size", ["1g", "200b", "37b"])
def test_records_do_not_depend_on_byte_ranges(spark, tmp_path, monkeypatch, size):
    """Many tasks for one file, ranges within one field: the rows of a reader of whole files."""
    monkeypatch.setattr(csv_records, "BATCH_BYTES", 100)
    rng = random.Random(7)
    for k in range(2):
        (tmp_path / f"part{k}.csv").write_bytes(_odd_csv(rng, 60).encode())
    (tmp_path / "last.csv").write_bytes(b'id,a b,c\n7,"no break at the end",\xc3\xa9')
    want = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path)).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got = csv_records.read_csv_in_ranges(spark, str(tmp_path))
        if size != "1g":
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        assert sorted(map(str, got.drop("file").collect())) == sorted(map(str, want)) and len(want) == 121
        assert {r["file"] for r in got.select("file").collect()} == {"part0.csv", "part1.csv", "last.csv"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_labels(reviews):
    assert {r["Hotel_Name"]: r["label"] for r in binary_labels(reviews).collect()} == {
        "A": "positive", "C": "negative", "D": "positive",
    }
    assert {r["Hotel_Name"]: r["label"] for r in three_class_labels(reviews).collect()} == {
        "A": "positive", "B": "neutral", "C": "negative", "D": "positive", "E": "neutral",
    }


def test_funnel_and_cleaning(reviews):
    row = row_funnel(reviews).head().asDict()
    assert (row["rows_loaded"], row["rows_after_labeling"]) == (5, 3)
    assert (row["rows_after_text_filter"], row["rows_after_cleaning"]) == (3, 2)
    assert row["dropped_by_empty_clean_text"] == 1
    kept = {r["Hotel_Name"]: r["clean_text"] for r in cleaned_rows(reviews).collect()}
    assert kept == {"A": "he said no and left", "C": "dirty room", "E": "fine noisy"}


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="Positive_Review"):
        with_text_columns(spark.createDataFrame([(1,)], "doc_id long"))
    with pytest.raises(ValueError, match="Reviewer_Score"):
        binary_labels(spark.createDataFrame([(1,)], "doc_id long"))
    with pytest.raises(ValueError, match="text column"):
        cleaned_rows(spark.createDataFrame([(1,)], "doc_id long"), "other")


def test_score_join_is_optional(spark):
    docs = spark.createDataFrame([(7, "one\ntwo", "s"), (8, "only", "s")], "doc_id long, text string, source string")
    rows = {r["doc_id"]: r for r in reviews_from_documents(docs).collect()}
    assert "Reviewer_Score" not in rows[7]
    assert (rows[7]["Positive_Review"], rows[7]["Negative_Review"]) == ("No Positive", "two")
    assert (rows[8]["Positive_Review"], rows[8]["Negative_Review"]) == ("only", "No Negative")


def test_queries(spark, tmp_path):
    path = tmp_path / "queries.txt"
    path.write_text("  first one \n\n\r\n second third")
    assert [(r[0], r[1]) for r in read_queries(spark, str(path)).orderBy("query_id").collect()] == [
        (1, "first one"), (2, "second"), (3, "third"),
    ]
    (tmp_path / "empty.txt").write_text("\n  \n")
    with pytest.raises(ValueError):
        read_queries(spark, str(tmp_path / "empty.txt"))
    with pytest.raises(ValueError):
        queries_from_list(spark, [])


def test_result_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b"\nc, d'), (2, "plain")], "id int, note string")
    write_csv(rows, str(tmp_path / "csv"))
    assert sorted(read_csv(spark, str(tmp_path / "csv"), "id int, note string").collect()) == sorted(rows.collect())
    nested = rows.select(F.struct("id", "note").alias("config"), F.lit(None).cast("double").alias("score"))
    write_json(nested, str(tmp_path / "json"))
    assert sorted(read_json(spark, str(tmp_path / "json"), nested.schema).collect()) == sorted(nested.collect())


def test_saved_index_gives_the_same_results(spark, tmp_path, reviews):
    settings = RetrievalSettings(tfidf=TfidfSettings(min_df=1, max_df=1.0, max_features=100, bigrams=True))
    index = index_reviews(reviews, settings)
    save_index(index, str(tmp_path / "index"))
    loaded = load_index(spark, str(tmp_path / "index"))
    queries = queries_from_list(spark, ["dirty room", "fine noise", "left"])
    columns = ["query_id", "rank", F.round("score", 9).alias("score"), "doc_id"]
    got = sorted(loaded.search(queries, 2).select(*columns).collect())
    assert got == sorted(index.search(queries, 2).select(*columns).collect()) and len(got) == 6
    assert loaded.statistics().collect() == index.statistics().collect()
    assert sorted(loaded.documents.collect()) == sorted(index.documents.collect())


def test_ids_do_not_depend_on_the_cluster(spark, tmp_path):
    for i in range(4):
        rows = "".join(f"H{i},{i}.5,good {j},bad {j}\n" for j in range(50))
        (tmp_path / f"part{i}.csv").write_text("Hotel_Name,Reviewer_Score,Positive_Review,Negative_Review\n" + rows)
    draws = []
    for size in ("128m", "600b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            reviews = read_reviews_csv(spark, str(tmp_path), multi_line=False)
            draws.append(sorted(map(str, exact_sample(reviews, 20).collect())))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(draws[0]) == 20 and draws[0] == draws[1]


def test_queries_of_several_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo\n")
    (tmp_path / "b.txt").write_text("three\n")
    got = sorted((r[0], r[1]) for r in read_queries(spark, str(tmp_path)).collect())
    assert got == [(1, "one"), (2, "two"), (3, "three")]


def test_cleaning_uses_the_chosen_column(spark):
    rows = spark.createDataFrame([(1, "Own text", "other", "x"), (2, "12", "other", "x")], "doc_id long, negative_text string, Negative_Review string, Positive_Review string")
    assert [r["clean_text"] for r in cleaned_rows(rows, "negative_text").collect()] == ["own text"]
