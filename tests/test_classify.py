import numpy as np
import pytest
from pyspark.sql import functions as F

from textlens.operators import linear_fit
from textlens.operators.classify import LinearClassifier, TrainingData, fit_model, fit_models_together, gradient_norms, top_terms
from textlens.operators.selection import (
    best_positions,
    chi2_from_matrix,
    chi2_scores,
    class_weight_matrix,
    class_weight_sums,
    select_k_best,
    slice_vectors,
)
from textlens.operators.tfidf import TfidfSettings, fit_tfidf

SETTINGS = TfidfSettings(1, 1.0, 100)


@pytest.fixture(scope="module")
def binary(spark, corpus):
    return data(spark, corpus, F.when(F.col("doc_id") % 3 == 0, "negative").otherwise("positive"))


@pytest.fixture(scope="module")
def three(spark, corpus):
    names = F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive"))
    return data(spark, corpus, F.element_at(names, (F.col("doc_id") % 3 + 1).cast("int")))


def data(spark, corpus, label):
    rows = corpus.withColumn("label", label)
    model = fit_tfidf(rows, SETTINGS)
    vectors = model.with_vectors(rows).select("doc_id", "label", "features").persist()
    counts = {r["label"]: r["count"] for r in vectors.groupBy("label").count().collect()}
    return TrainingData(vectors, counts, model.position_terms), model


def dense(training):
    rows = training.vectors.orderBy("doc_id").collect()
    return np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows])


@pytest.mark.parametrize("name", ["binary", "three"])
def test_chi2(spark, request, name):
    training, model = request.getfixturevalue(name)
    x, y = dense(training)
    observed = np.array([x[y == c].sum(axis=0) for c in training.classes])
    share = np.array([(y == c).mean() for c in training.classes])
    expected = share[:, None] * x.sum(axis=0)
    want = ((observed - expected) ** 2 / expected).sum(axis=0)
    counts = [training.class_counts[c] for c in training.classes]
    assert chi2_from_matrix(training.class_sums(), counts) == pytest.approx(want)
    sums = class_weight_sums(training.vectors).join(model.positions(spark), "position")
    table = chi2_scores(
        sums.select("term", "label", "weight_sum"),
        spark.createDataFrame(list(training.class_counts.items()), "label string, n long"),
    )
    got = {r["term"]: r["chi2"] for r in table.collect()}
    assert got == pytest.approx(dict(zip(training.terms, want)))
    best = {r["term"] for r in select_k_best(table, 4).collect()}
    assert best == {training.terms[i] for i in best_positions(want, training.terms, 4)}


def test_selection_bounds_and_ties():
    assert best_positions(np.array([1.0, 3.0, 3.0, 3.0]), ["d", "c", "b", "a"], 2) == [1, 2]
    assert best_positions(np.array([1.0, 2.0]), ["a", "b"], 0) == [0, 1]
    assert best_positions(np.array([1.0, 2.0]), ["a", "b"], 5) == [0, 1]


def test_sliced_vectors(binary):
    training, _ = binary
    x, _ = dense(training)
    kept = [0, 2, 5]
    rows = slice_vectors(training.vectors, kept, "features", "selected").orderBy("doc_id").collect()
    assert np.allclose([r["selected"].toArray() for r in rows], x[:, kept])


@pytest.mark.parametrize("name", ["binary", "three"])
def test_naive_bayes(request, name):
    training, _ = request.getfixturevalue(name)
    x, y = dense(training)
    fit = fit_model(training, "naive_bayes")
    sums = np.array([x[y == c].sum(axis=0) for c in training.classes]) + 1
    likelihood = np.log(sums / sums.sum(axis=1, keepdims=True))
    prior = np.log([(y == c).mean() for c in training.classes])
    scores = x @ likelihood.T + prior
    chance = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    rows = fit.predict(training.vectors, "negative").orderBy("doc_id").collect()
    assert [r["prediction"] for r in rows] == [training.classes[i] for i in scores.argmax(axis=1)]
    assert [r["target_score"] for r in rows] == pytest.approx(list(chance[:, 0]))


def gradient(training, fit, kind):
    """Numeric slope of the full objective at the fitted weights."""
    x, y = dense(training)
    target = np.array([training.classes.index(c) for c in y])
    w = np.column_stack([fit.coefficients, fit.intercepts])

    def objective(w):
        margins = x @ w[:, :-1].T + w[:, -1]
        if kind == "linear_svm":
            wanted = [1] if len(w) == 1 else range(len(w))
            side = np.where(target[:, None] == np.array(list(wanted)), 1.0, -1.0)
            return (np.maximum(0, 1 - side * margins) ** 2).sum() + 0.5 * (w**2).sum()
        full = np.column_stack([np.zeros(len(x)), margins]) if len(w) == 1 else margins
        loss = np.log(np.exp(full).sum(axis=1)) - full[np.arange(len(x)), target]
        return loss.sum() + 0.5 * (w[:, :-1] ** 2).sum()

    slope = np.zeros_like(w)
    for i in np.ndindex(w.shape):
        step = np.zeros_like(w)
        step[i] = 1e-5
        slope[i] = (objective(w + step) - objective(w - step)) / 2e-5
    return np.linalg.norm(slope), objective(w), objective(np.zeros_like(w))


@pytest.mark.parametrize("name", ["binary", "three"])
@pytest.mark.parametrize("kind", ["logistic_regression", "linear_svm"])
def test_iterative_fits_reach_the_optimum(request, name, kind):
    training, _ = request.getfixturevalue(name)
    fit = fit_model(training, kind)
    slope, value, at_zero = gradient(training, fit, kind)
    assert slope < 5e-3 and value < at_zero
    x, _ = dense(training)
    scores = x @ fit.coefficients.T + fit.intercepts
    rows = fit.predict(training.vectors, "negative").orderBy("doc_id").collect()
    if len(fit.coefficients) == 1:
        want = np.where(scores[:, 0] > 0, *reversed(training.classes))
        target = 1 / (1 + np.exp(scores[:, 0])) if fit.has_probability else -scores[:, 0]
    else:
        want = np.array(training.classes)[scores.argmax(axis=1)]
        chance = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
        target = chance[:, 0] if fit.has_probability else scores[:, 0]
    assert [r["prediction"] for r in rows] == list(want)
    assert [r["target_score"] for r in rows] == pytest.approx(list(target))


def test_tree_sums_equal_direct_sums(binary, monkeypatch):
    training, _ = binary
    direct = fit_model(training, "linear_svm")
    monkeypatch.setattr(linear_fit, "DIRECT_PARTS", 0)
    tree = fit_model(training, "linear_svm")
    assert np.allclose(direct.coefficients, tree.coefficients, atol=1e-3)


@pytest.mark.parametrize("name", ["binary", "three"])
def test_fits_side_by_side_equal_fits_alone(request, monkeypatch, name):
    """Masks on the same vectors against sliced vectors; blocks of few entries; passes are shared."""
    training, _ = request.getfixturevalue(name)
    kept = [0, 2, 3, 5, 8]
    monkeypatch.setattr(linear_fit, "BLOCK_ENTRIES", 5)
    passes = []
    real = linear_fit.summed
    monkeypatch.setattr(linear_fit, "summed", lambda blocks, asked, *a: passes.append(len(asked)) or real(blocks, asked, *a))
    wanted = [(m, k) for m in ("linear_svm", "naive_bayes", "logistic_regression") for k in (None, kept)]
    together = fit_models_together(training, wanted)
    shared = list(passes)
    sliced = TrainingData(slice_vectors(training.vectors, kept, "features", "few"), training.class_counts, [training.terms[i] for i in kept], features="few")
    for (model, k), fit in zip(wanted, together, strict=True):
        alone = fit_model(training if k is None else sliced, model)
        places = range(len(training.terms)) if k is None else k
        assert np.allclose(fit.coefficients[:, places], alone.coefficients, atol=2e-3)
        assert np.allclose(fit.intercepts, alone.intercepts, atol=2e-3)
        assert np.count_nonzero(np.delete(fit.coefficients, list(places), axis=1)) == 0
        assert [t for t, _ in fit.kept_weights(fit.coefficients[0])] == alone.terms
    assert max(shared) == 4 and len(shared) < sum(passes[len(shared):])
    with pytest.raises(ValueError, match="no model"):
        fit_model(training, "tree")


@pytest.mark.parametrize("kind", ["logistic_regression", "linear_svm"])
def test_gradient_vanishes_at_fits_only(binary, kind):
    training, _ = binary
    fit = fit_model(training, kind)
    row = gradient_norms(training, fit).head()
    slope, *_ = gradient(training, fit, kind)
    assert row["norm"] == pytest.approx(slope, abs=1e-4) and row["norm"] <= 1.01e-4 * row["norm_at_zero"]
    fit.coefficients[0, 0] += 0.1
    assert gradient_norms(training, fit).head()["norm"] > 0.05
    with pytest.raises(ValueError):
        gradient_norms(training, fit_model(training, "naive_bayes"))


def test_rows_without_terms_and_empty_parts(spark, binary):
    """Texts without known terms count with their intercept; partitions without rows bring nothing."""
    training, _ = binary
    spread = TrainingData(training.vectors.repartition(40), training.class_counts, training.terms)
    assert np.allclose(fit_model(spread, "linear_svm").coefficients, fit_model(training, "linear_svm").coefficients, atol=1e-3)


def test_scaled_directions_take_fewer_passes(spark, monkeypatch):
    """A frequent term and rare ones, over more partitions than cores: one sum a core, and the optimum in fewer passes
    than without scales."""
    draw = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        rare = draw.choice(np.arange(1, 400), 6, replace=False)
        rows.append((int(i), "negative" if draw.random() < 0.4 else "positive", [0, *sorted(map(int, rare))], [0.8, *draw.random(6).tolist()]))
    from pyspark.ml.linalg import SparseVector, VectorUDT

    sparse = F.udf(lambda p, w: SparseVector(400, p, w), VectorUDT())
    vectors = spark.createDataFrame(rows, "doc_id long, label string, p array<int>, w array<double>").repartition(30)
    vectors = vectors.select("doc_id", "label", sparse("p", "w").alias("features")).persist()
    counts = {r["label"]: r["count"] for r in vectors.groupBy("label").count().collect()}
    training = TrainingData(vectors, counts, [f"t{i:03}" for i in range(400)])
    seen = []
    real = linear_fit.summed
    monkeypatch.setattr(linear_fit, "summed", lambda blocks, asked, size, parts: seen.append(parts) or real(blocks, asked, size, parts))
    for kind in ("linear_svm", "logistic_regression"):
        seen.clear()
        fit = fit_model(training, kind)
        scaled = len(seen)
        assert max(seen) <= spark.sparkContext.defaultParallelism
        row = gradient_norms(training, fit).head()
        assert row["norm"] <= 1.01e-4 * row["norm_at_zero"]
        seen.clear()
        with monkeypatch.context() as plain:
            whole = linear_fit.steps
            plain.setattr(linear_fit, "steps", lambda start, tolerance, most, scale=1.0: whole(start, tolerance, most, 10))
            fit_model(training, kind)
        assert scaled < len(seen)
    vectors.unpersist()


def test_top_terms(spark):
    def model(classes, coefficients):
        return LinearClassifier(
            "m", classes, ["a", "b", "c", "d"], np.array(coefficients), np.zeros(len(coefficients)), False, True
        )

    two = model(["negative", "positive"], [[0.5, -1.0, 2.0, 0.5]])
    got = [(r[0], r[1], r[2]) for r in top_terms(two.term_weights(spark), 2, 2).collect()]
    assert sorted(got) == [("negative", 1, "b"), ("negative", 2, "a"), ("positive", 1, "c"), ("positive", 2, "a")]
    more = model(["x", "y", "z"], np.eye(3, 4))
    got = [(r[0], r[1], r[2]) for r in top_terms(more.term_weights(spark), 3, 1).collect()]
    assert sorted(got) == [("x", 1, "a"), ("y", 1, "b"), ("z", 1, "c")]


def test_the_driver_gets_one_array_of_sums(spark):
    from textlens.operators import linear_fit

    for parts in (1, 5, 40):
        rows = spark.range(parts, numPartitions=parts).select(F.lit(np.array([1.0, 2.0]).tobytes()).alias("sums"))
        found = linear_fit.added_up(rows, parts).collect()
        assert [np.frombuffer(r["sums"]).tolist() for r in found] == [[parts, 2.0 * parts]]


def test_only_kept_positions_are_packed(binary, monkeypatch):
    """Positions that no model keeps are left out of what each pass reads; the others take one byte each here."""
    training, _ = binary
    x, _ = dense(training)
    read = []
    real = linear_fit.summed

    def seen(blocks, asked, size, parts):
        sizes = blocks.selectExpr("length(positions) AS p", "length(weights) AS w", "length(targets) AS t").collect()
        read.append((size, sum(r["p"] for r in sizes), sum(r["w"] for r in sizes), sum(r["t"] for r in sizes)))
        return real(blocks, asked, size, parts)

    monkeypatch.setattr(linear_fit, "summed", seen)
    few, other = [1, 4, 7], [0, 4]
    for wanted, used in (([few], few), ([few, other], [0, 1, 4, 7]), ([few, None], list(range(x.shape[1])))):
        read.clear()
        fits = fit_models_together(training, [("linear_svm", k) for k in wanted])
        entries = np.count_nonzero(x[:, used])
        assert set(read) == {(len(used), entries, 8 * entries, 8 * len(x))}
        for k, fit in zip(wanted, fits, strict=True):
            alone = fit_model(training, "linear_svm", k)
            assert np.allclose(fit.coefficients, alone.coefficients, atol=2e-3)
            assert k is None or np.count_nonzero(np.delete(fit.coefficients, k, axis=1)) == 0


def test_place_types():
    assert [linear_fit.place_type(n) for n in (0, 1, 256, 257, 65_536, 65_537)] == [np.uint8] * 3 + [np.uint16] * 2 + [np.uint32]


def test_class_sums_are_added_up_in_tasks(spark, three):
    """One array a core and none from empty parts; a vector may be dense, and a class may lack rows."""
    from pyspark.ml.linalg import Vectors

    training, _ = three
    x, y = dense(training)
    want = np.array([x[y == c].sum(axis=0) for c in training.classes])
    for parts in (1, 40):
        assert np.allclose(class_weight_matrix(training.vectors.repartition(parts), training.classes, x.shape[1]), want)
    rows = [("b", Vectors.dense([1.0, 0.0, 2.0])), ("a", Vectors.sparse(3, [2], [0.5])), ("b", Vectors.sparse(3, [], [])), ("b", Vectors.sparse(3, [0], [4.0]))]
    mixed = spark.createDataFrame(rows, ["label", "features"])
    assert class_weight_matrix(mixed, ["a", "b", "c"], 3).tolist() == [[0, 0, 0.5], [5.0, 0, 2.0], [0, 0, 0]]
    assert class_weight_matrix(mixed.filter("label = 'x'"), ["a"], 3).tolist() == [[0, 0, 0]]


def test_packed_cells_stay_small(spark, monkeypatch):
    """A batch of rows is cut: cells do not grow with it. A row of many entries is whole, rows without any stay."""
    monkeypatch.setattr(linear_fit, "BLOCK_ENTRIES", 50)
    counts = [3, 0, 7] * 40 + [400, 0, 0, 5] + [1] * 100
    data = [(i % 2, list(range(n)), [float(i + 1)] * n) for i, n in enumerate(counts)]
    rows = spark.createDataFrame(data, "target int, positions array<int>, weights array<double>").coalesce(1)
    blocks = linear_fit.packed(rows, 400)
    sizes = [len(r["weights"]) // 8 for r in blocks.collect()]
    assert max(sizes) <= 400 + 50 and sum(n > 100 for n in sizes) <= 1 and sum(sizes) == sum(counts)
    x = np.zeros((len(counts), 400))
    for i, n in enumerate(counts):
        x[i, :n] = i + 1
    weights = np.linspace(-0.01, 0.01, 401)[None, :]
    value, slope = linear_fit.squared_hinge((x @ weights[0, :-1] + weights[0, -1])[:, None], np.array([t for t, _, _ in data]))
    for pass_entries in (1, 1 << 20):
        monkeypatch.setattr(linear_fit, "PASS_ENTRIES", pass_entries, raising=False)
        total = linear_fit.summed(blocks, [(linear_fit.squared_hinge, weights, None)], 400, 1)[0]
        assert np.allclose(total, np.concatenate([slope[:, 0] @ x, [slope.sum(), value]]))
    assert np.allclose(linear_fit.squared_sums(blocks, 400), np.append((x**2).sum(axis=0), len(counts)))


def test_blocks_are_put_together(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(linear_fit, "PASS_ENTRIES", 4)
    parts = [([0], [2], [1, 2], [0.5, 1.0]), ([1, 0], [0, 3], [0, 1, 2], [1.0, 2.0, 3.0]), ([1], [0], [], [])]
    kinds = (np.int64, np.int64, np.uint8, float)
    columns = [pa.array([np.array(p[c], kind).tobytes() for p in parts], pa.binary()) for c, kind in enumerate(kinds)]
    found = [[x.tolist() for x in block] for block in linear_fit.blocks_of(pa.RecordBatch.from_arrays(columns, ["targets", "ends", "positions", "weights"]), 3)]
    assert found == [[[0, 1, 0], [2, 2, 5], [1, 2, 0, 1, 2], [0.5, 1.0, 1.0, 2.0, 3.0]], [[1], [0], [], []]]


def test_vectors_of_a_classification_are_kept_on_disk(spark, sf_dir):
    from catalog import tables
    from textlens.plans.classification import split_and_vectorise

    data = split_and_vectorise(tables.reviews(spark, sf_dir), tables.CLASSIFY)
    level = data.vectors.storageLevel
    assert level.useDisk and not level.useMemory
    data.release()
