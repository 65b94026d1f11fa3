"""The pipeline and its stages against plain versions."""

import brute_llm as brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

PASSAGE = " ".join(f"item{i}" for i in range(20))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    long = [" ".join(f"d{i}w{j}" for j in range(60)) for i in range(12)]
    rows = [(i, f"{t}\nSame line\nend {i}") for i, t in enumerate(long)]
    rows += [(20, long[0] + "\nsame LINE \nend 0 more"), (21, long[1] + " " + PASSAGE), (22, long[2] + f"\nmore {PASSAGE}"), (23, "too short"), (24, None), (25, ("again " * 30 + "\n") * 3), (5, f"{long[5]}\nSame line\nend 5")]
    docs = spark.createDataFrame([(d, t, "en", "src", len(t or ""), "own", True) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, block string, kept boolean")
    docs.repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "best-fit packing"]


def test_run(spark, tables):
    path, rows = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    state = [(d, t) for d, t in rows]
    state = [(d, t) for d, t in state if brute.quality(t)[-1]]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "block", "kept"]
        if name == "line dedup":
            keys = {}
            for d, t in state:
                for line in t.split("\n"):
                    keys.setdefault(line.strip().lower(), set()).add(d)
            state = [(d, "\n".join(x for x in t.split("\n") if not x.strip() or len(keys[x.strip().lower()]) < 10)) for d, t in state]
        if name == "near dedup":
            head = {d: c for d, _, c in brute.near_duplicates(state, 5, 80)}
            state = sorted({(d, t) for d, t in state if head[d] == d})
        if name == "decontamination":
            bad = {d for d, *_, hit in brute.contamination(state, [(1, PASSAGE)]) if hit}
            state = [(d, t) for d, t in state if d not in bad]
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted(state)
    got = corpus_pipeline.run(spark, path)
    assert sorted(r["doc_id"] for r in got.select("doc_id").distinct().collect()) == sorted(d for d, _ in state)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


@pytest.mark.parametrize("number", range(5))
def test_stages_take_nulls_and_empty_tables(spark, tables, odd, none, number):
    path, _ = tables
    _, stage = corpus_pipeline.STAGES[number]
    assert stage(spark, none, path).count() == 0
    wide = odd.filter("doc_id IS NULL OR doc_id < 300").withColumns({"n_chars": F.lit(None).cast("int"), "spans": F.lit("x"), "sequence_id": F.lit(1), "_row": F.lit(None).cast("string")})
    out = stage(spark, wide, path)
    assert number == 4 or out.columns == wide.columns
    assert out.count() <= wide.count() or number == 4
