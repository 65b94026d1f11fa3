"""Linear text classifiers on document vectors: naive Bayes, logistic regression, linear SVM."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlens.functions.vectors import heaviest, vector_entries, with_dot_products
from textlens.operators.linear_fit import Problem, fit_linear, logistic, squared_hinge
from textlens.operators.selection import class_weight_matrix


@dataclass
class TrainingData:
    """Training vectors (persisted by the caller) with their classes and terms by position."""

    vectors: DataFrame
    class_counts: dict[str, int]
    terms: list[str]
    features: str = "features"
    label: str = "label"
    weight_sums: np.ndarray | None = None

    @property
    def classes(self) -> list[str]:
        return sorted(self.class_counts)

    @property
    def n_rows(self) -> int:
        return sum(self.class_counts.values())

    def class_sums(self) -> np.ndarray:
        if self.weight_sums is None:
            self.weight_sums = class_weight_matrix(
                self.vectors, self.classes, len(self.terms), self.label, self.features
            )
        return self.weight_sums


@dataclass
class LinearClassifier:
    """Scores are ``coefficients @ x + intercepts``: one row per class, or a single row for two
    classes (positive means the second class)."""

    name: str
    classes: list[str]
    terms: list[str]
    coefficients: np.ndarray
    intercepts: np.ndarray
    has_probability: bool
    has_term_weights: bool
    features: str = "features"
    # Positions of selected terms; the others have coefficient 0. None: all.
    kept: list[int] | None = None

    def _scored(self, df: DataFrame) -> DataFrame:
        scored = with_dot_products(df, self.features, self.coefficients, "__scores")
        shifts = F.array(*[F.lit(float(b)) for b in self.intercepts])
        return scored.withColumn("__scores", F.zip_with("__scores", shifts, lambda s, b: s + b))

    def _prediction(self) -> Column:
        names = F.array(*[F.lit(c) for c in self.classes])
        if len(self.coefficients) == 1:
            return F.when(F.col("__scores")[0] > 0, self.classes[1]).otherwise(self.classes[0])
        best = F.array_position("__scores", F.array_max("__scores"))
        return F.element_at(names, best.cast("int"))

    def _target_score(self, target: str) -> Column:
        scores, place = F.col("__scores"), self.classes.index(target)
        if len(self.coefficients) == 1:
            decision = scores[0] if place == 1 else -scores[0]
            return 1 / (1 + F.exp(-decision)) if self.has_probability else decision
        if not self.has_probability:
            return scores[place]
        relative = F.transform("__scores", lambda s: F.exp(s - scores[place]))
        return 1 / F.aggregate(relative, F.lit(0.0), lambda acc, v: acc + v)

    def predict(self, df: DataFrame, target: str | None = None) -> DataFrame:
        """Add ``prediction``, and with ``target`` also ``target_score``: the probability of that
        class, or the signed decision value of a model without probabilities. Narrow."""
        columns = {"prediction": self._prediction()}
        if target is not None:
            columns["target_score"] = self._target_score(target)
        return self._scored(df).withColumns(columns).drop("__scores")

    def term_weights(self, spark: SparkSession) -> DataFrame:
        """(class_label, term, weight); two classes share one set of weights, under the second."""
        schema = "class_label string, term string, weight double"
        if not self.has_term_weights:
            return spark.createDataFrame([], schema)
        names = [self.classes[1]] if len(self.coefficients) == 1 else self.classes
        rows = [
            (name, term, float(weight))
            for name, row in zip(names, self.coefficients)
            for term, weight in self.kept_weights(row)
        ]
        return spark.createDataFrame(rows, schema)

    def kept_weights(self, row: np.ndarray) -> list[tuple[str, float]]:
        places = range(len(self.terms)) if self.kept is None else self.kept
        return [(self.terms[i], row[i]) for i in places]


def fit_naive_bayes(data: TrainingData, alpha: float = 1.0, kept: list[int] | None = None) -> LinearClassifier:
    """Multinomial naive Bayes with smoothed terms and unsmoothed priors, over the kept positions."""
    places = np.arange(len(data.terms)) if kept is None else np.asarray(kept, dtype=int)
    smoothed = data.class_sums()[:, places] + alpha
    counts = np.array([data.class_counts[c] for c in data.classes], dtype=float)
    coefficients = np.zeros((len(data.classes), len(data.terms)))
    coefficients[:, places] = np.log(smoothed) - np.log(smoothed.sum(axis=1, keepdims=True))
    return LinearClassifier(
        "naive_bayes",
        data.classes,
        data.terms,
        coefficients,
        np.log(counts / counts.sum()),
        has_probability=True,
        has_term_weights=False,
        features=data.features,
        kept=kept,
    )


# Losses of the models that are fitted in steps, and whether their intercept is penalised and gives no probability.
FITTED = {"logistic_regression": (logistic, False, 2000), "linear_svm": (squared_hinge, True, 1000)}
MODELS = ("naive_bayes", *FITTED)


def fit_models_together(data: TrainingData, wanted: list[tuple[str, list[int] | None]], cost: float = 1.0) -> list[LinearClassifier]:
    """A classifier for each (model, kept positions or None for all). Models that are fitted in steps share every pass
    over the training rows.

    Logistic regression: L2, free intercept, multinomial for three or more classes. Linear SVM: squared hinge, penalised
    intercept, one against the rest for three or more classes.
    """
    for name, _ in wanted:
        if name not in MODELS:
            raise ValueError(f"There is no model {name}; models are {', '.join(MODELS)}.")
    stepwise = [(i, *FITTED[name], kept) for i, (name, kept) in enumerate(wanted) if name in FITTED]
    problems = [
        Problem(loss, cost, penalised, None if kept is None else np.asarray(kept, dtype=int), max_iterations=most)
        for _, loss, penalised, most, kept in stepwise
    ]
    found = fit_linear(data.vectors, data.classes, len(data.terms), problems, data.features, data.label) if problems else []
    fitted = {i: x for (i, *_), x in zip(stepwise, found, strict=True)}
    out = []
    for i, (name, kept) in enumerate(wanted):
        if name == "naive_bayes":
            out.append(fit_naive_bayes(data, kept=kept))
        else:
            out.append(
                LinearClassifier(
                    name, data.classes, data.terms, *fitted[i], has_probability=name == "logistic_regression",
                    has_term_weights=True, features=data.features, kept=kept,
                )
            )
    return out


def fit_model(data: TrainingData, name: str, kept: list[int] | None = None, cost: float = 1.0) -> LinearClassifier:
    return fit_models_together(data, [(name, kept)], cost)[0]


def gradient_norms(data: TrainingData, model: LinearClassifier, cost: float = 1.0) -> DataFrame:
    """(model, norm, norm_at_zero): length of the gradient of a two-class model's objective at its weights and at zero
    weights. Worked out with column expressions, apart from the fit, as a certificate of it: a convex objective is least
    where its gradient vanishes."""
    if len(data.classes) != 2 or model.name not in FITTED:
        raise ValueError("The gradient is that of a two-class model fitted in steps.")
    side = F.when(F.col(data.label) == data.classes[1], 1.0).otherwise(-1.0)
    weights = [(i, float(model.coefficients[0, i])) for i in (model.kept or range(len(model.terms)))]
    weights.append((-1, float(model.intercepts[0]) if FITTED[model.name][1] else 0.0))
    spark = data.vectors.sparkSession
    own = spark.createDataFrame(weights, "position int, weight double")

    def slope(margin: Column) -> Column:
        if model.name == "linear_svm":
            return -2.0 * side * F.greatest(F.lit(0.0), 1.0 - side * margin)
        return 1.0 / (1.0 + F.exp(-margin)) - F.when(side > 0, 1.0).otherwise(0.0)

    scored = model._scored(data.vectors).withColumns({"__at": slope(F.col("__scores")[0]), "__zero": slope(F.lit(0.0))})
    entries = F.concat(
        F.transform(vector_entries(data.features), lambda e: F.struct(e["position"].cast("int").alias("position"), e["value"].alias("value"))),
        F.array(F.struct(F.lit(-1).alias("position"), F.lit(1.0).alias("value"))),
    )
    rows = scored.select("__at", "__zero", F.explode(entries).alias("e"))
    sums = rows.groupBy(F.col("e.position").alias("position")).agg(F.sum(F.col("__at") * F.col("e.value")).alias("at"), F.sum(F.col("__zero") * F.col("e.value")).alias("zero"))
    parts = own.join(sums, "position", "left").select(
        (cost * F.coalesce("at", F.lit(0.0)) + F.col("weight")).alias("at"), (cost * F.coalesce("zero", F.lit(0.0))).alias("zero")
    )
    return parts.agg(F.sqrt(F.sum(F.col("at") * F.col("at"))).alias("norm"), F.sqrt(F.sum(F.col("zero") * F.col("zero"))).alias("norm_at_zero")).select(
        F.lit(model.name).alias("model"), "norm", "norm_at_zero"
    )


def top_model_terms(spark: SparkSession, model: LinearClassifier, top_n: int = 20) -> DataFrame:
    """`top_terms` of a fitted model, chosen on its arrays: only the ranked rows leave the driver."""
    schema = "class_label string, rank int, term string, weight double"
    if not model.has_term_weights:
        return spark.createDataFrame([], schema)
    if len(model.coefficients) == 1:
        first = model.coefficients[0]
        sides = [("positive", first, first), ("negative", -first, first)]
    else:
        sides = [(name, row, row) for name, row in zip(model.classes, model.coefficients, strict=True)]
    rows = [
        (name, rank, model.terms[i], float(weights[i]))
        for name, wanted, weights in sides
        for rank, i in enumerate(heaviest(wanted, model.terms, top_n, model.kept), start=1)
    ]
    return spark.createDataFrame(rows, schema)


def top_terms(weights: DataFrame, n_classes: int, top_n: int = 20) -> DataFrame:
    """(class_label, rank, term, weight): the strongest terms of (class_label, term, weight).

    For two classes the highest weights speak for the second class and the lowest for the first; the
    latter are listed under "negative", as the labels of that task are negative and positive.
    """
    rounded = F.round("weight", 6)

    def ranked(df: DataFrame, order: Column) -> DataFrame:
        window = Window.partitionBy("class_label").orderBy(order, F.asc("term"))
        return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= top_n)

    highest = ranked(weights, rounded.desc())
    if n_classes == 2:
        lowest = ranked(weights, rounded.asc()).withColumn("class_label", F.lit("negative"))
        highest = highest.withColumn("class_label", F.lit("positive")).unionByName(lowest)
    return highest.select("class_label", "rank", "term", "weight")
