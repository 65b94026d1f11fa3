import random

import pytest

from textlens.operators import curves
from textlens.operators.evaluate import class_report, confusion_matrix, model_summary, overall_report

# Confusion counts (nn, np, pn, pp) and metrics (macro precision, recall, F1, weighted F1,
# accuracy) of recorded runs.
RECORDED = {
    "linear_svm": ((3944, 2181, 823, 66250), (0.8977416051104927, 0.8158240771477436, 0.8510160806817129, 0.9566079053808035, 0.9589606273395448)),
    "logistic_regression": ((3652, 2473, 584, 66489), (0.9131368799431057, 0.7937689833525885, 0.8412395508151964, 0.954719410609088, 0.9582365638405421)),
    "naive_bayes": ((3395, 2730, 607, 66466), (0.9044363447503372, 0.7726179365339683, 0.8229982571335599, 0.9499878961274009, 0.9544113227137353)),
    "small_svm": ((321, 282, 90, 6411), (0.8694441627105779, 0.7592471422307017, 0.8024707303750225, 0.9430585233594468, 0.9476351351351351)),
    "small_bayes": ((136, 467, 10, 6491), (0.932194930837471, 0.6120003734595749, 0.6638549494776749, 0.9135104497021626, 0.9328547297297297)),
}


def predictions(spark, nn, np_, pn, pp):
    cells = [("negative", "negative", nn), ("negative", "positive", np_), ("positive", "negative", pn), ("positive", "positive", pp)]
    rows = spark.createDataFrame(cells, "label string, prediction string, n int")
    return rows.selectExpr("label", "prediction", "explode(sequence(1, n)) AS i").drop("i")


def test_recorded_metrics(spark):
    reports = {n: overall_report(confusion_matrix(predictions(spark, *c))) for n, (c, _) in RECORDED.items()}
    rows = model_summary(reports).collect()
    assert [r["model"] for r in rows][0] == "linear_svm"
    assert [r["macro_f1"] for r in rows] == sorted((r["macro_f1"] for r in rows), reverse=True)
    for r in rows:
        assert tuple(r)[1:] == pytest.approx(RECORDED[r["model"]][1], abs=1e-12)


def test_zero_cells_and_empty_denominators(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "c")], "label string, prediction string")
    confusion = confusion_matrix(rows)
    cells = {(r[0], r[1]): r[2] for r in confusion.collect()}
    assert len(cells) == 9 and cells["a", "b"] == 2 and cells["c", "c"] == 1 and sum(cells.values()) == 3
    report = {r["label"]: tuple(r)[1:] for r in class_report(confusion).collect()}
    assert report == {"a": (0.0, 0.0, 0.0, 2), "b": (0.0, 0.0, 0.0, 0), "c": (1.0, 1.0, 1.0, 1)}


def brute_steps(rows):
    steps, tp, fp = [], 0, 0
    for s in sorted({s for _, s in rows}, reverse=True):
        h = sum(1 for y, v in rows if v == s and y)
        m = sum(1 for y, v in rows if v == s and not y)
        tp, fp = tp + h, fp + m
        steps.append((s, h, m, tp, fp))
    return steps


@pytest.mark.parametrize("ranges", [None, 1, 7, 1000])
@pytest.mark.parametrize("levels", [4, 40, 1])
def test_curves(spark, levels, ranges):
    """Signed scores too, as those of a linear SVM."""
    draw = random.Random(levels)
    rows = [(draw.random() < 0.3, draw.randrange(levels) / 8 - 2) for _ in range(200)]
    frame = spark.createDataFrame(
        [("negative" if y else "positive", s) for y, s in rows], "label string, target_score double"
    )
    steps = brute_steps(rows)
    pos, neg = steps[-1][3], steps[-1][4]
    result = curves.curve(frame, ranges=ranges)
    pr = [tuple(r) for r in result.precision_recall().orderBy("point").collect()]
    want = [(tp / pos, tp / (tp + fp), s) for s, _, _, tp, fp in reversed(steps)] + [(0.0, 1.0, None)]
    assert pr == [(i, *p) for i, p in enumerate(want)]
    kept = [
        i for i in range(len(steps))
        if i in (0, len(steps) - 1) or steps[i][1:3] != steps[i + 1][1:3]
    ]
    roc = [tuple(r) for r in result.roc().orderBy("point").collect()]
    want = [(0.0, 0.0, float("inf"))] + [(steps[i][4] / neg, steps[i][3] / pos, steps[i][0]) for i in kept]
    assert roc == [(i, *p) for i, p in enumerate(want)]
    ap = sum(h / pos * tp / (tp + fp) for _, h, _, tp, fp in steps)
    pairs = sum((a > b) + 0.5 * (a == b) for y, a in rows if y for z, b in rows if not z)
    row = result.metrics().head()
    assert row["average_precision"] == pytest.approx(ap)
    assert row["roc_auc"] == pytest.approx(pairs / pos / neg)
    assert row["prevalence"] == pytest.approx(pos / len(rows))


def test_curves_over_many_arrow_batches(spark):
    """Runs of one range that span batches join without gaps."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = spark.range(500).selectExpr("IF(id % 3 = 0, 'negative', 'positive') AS label", "-(id * 7919 % 250) / 10.0 AS target_score")
        found = [sorted(map(str, getattr(curves.curve(rows, ranges=n), kind)().collect())) for n in (1, 4) for kind in ("precision_recall", "roc")]
        assert found[:2] == found[2:] and len(found[0]) == 251
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("only", ["negative", "positive"])
def test_curves_without_a_class(spark, only):
    rows = spark.createDataFrame([(only, 0.2), (only, 0.9)], "label string, target_score double")
    result = curves.curve(rows)
    metrics = result.metrics().head()
    assert metrics["roc_auc"] is None and metrics["prevalence"] == (1.0 if only == "negative" else 0.0)
    assert (metrics["average_precision"] is None) == (only == "positive")
    assert len(result.roc().collect()) == 3 and len(result.precision_recall().collect()) == 3
