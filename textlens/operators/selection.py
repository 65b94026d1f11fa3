"""Chi-square term selection on real-valued weights."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlens.functions.vectors import vector_entries, vector_positions, vector_values
from textlens.operators.linear_fit import added_up


def class_weight_sums(vectors: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """(position, label, weight_sum): summed weight of every term in every class it occurs in."""
    return (
        vectors.select(F.col(label).alias("label"), F.explode(vector_entries(features)).alias("entry"))
        .groupBy(F.col("entry.position").alias("position"), "label")
        .agg(F.sum("entry.value").alias("weight_sum"))
    )


def class_weight_matrix(
    vectors: DataFrame, classes: list[str], size: int, label: str = "label", features: str = "features"
) -> np.ndarray:
    """The same sums as a classes-by-terms array on the driver: the size of a fitted model. Each task adds up its own rows
    in one such array."""
    names = F.array(*[F.lit(c) for c in classes])
    rows = vectors.select(
        (F.array_position(names, F.col(label)).cast("int") - 1).alias("target"),
        vector_positions(features).alias("positions"),
        vector_values(features).alias("weights"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(classes) * size)
        for batch in batches:
            target, at, values = (batch.column(c) for c in ("target", "positions", "weights"))
            first = target.to_numpy(zero_copy_only=False).astype(np.int64) * size
            cells = np.repeat(first, at.value_lengths().to_numpy(zero_copy_only=False)) + at.flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(cells, weights=values.flatten().to_numpy(zero_copy_only=False), minlength=len(total))
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    # One array a core, however many parts the table has.
    cores = max(1, vectors.sparkSession.sparkContext.defaultParallelism)
    sums = added_up(rows.coalesce(cores).mapInArrow(run, "sums binary"), cores)
    total = sum((np.frombuffer(r["sums"]) for r in sums.collect()), np.zeros(len(classes) * size))
    return total.reshape(len(classes), size)


def chi2_scores(term_sums: DataFrame, class_counts: DataFrame) -> DataFrame:
    """(term, chi2) from (term, label, weight_sum) and (label, n).

    A class without the term counts with an observed weight of zero: its share of the statistic is the
    expected weight itself. So the sum over the cells present is completed by the absent shares, and
    no empty cells need to be made.
    """
    shares = class_counts.select("label", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))
    totals = term_sums.groupBy("term").agg(F.sum("weight_sum").alias("total"))
    cells = term_sums.join(F.broadcast(shares), "label").join(totals, "term")
    expected = F.col("share") * F.col("total")
    observed = F.col("weight_sum")
    return (
        cells.groupBy("term")
        .agg(
            F.sum((observed - expected) * (observed - expected) / expected).alias("present"),
            (F.first("total") * (1 - F.sum("share"))).alias("absent"),
        )
        .select("term", (F.col("present") + F.greatest("absent", F.lit(0.0))).alias("chi2"))
    )


def select_k_best(scores: DataFrame, k: int) -> DataFrame:
    """The k terms with the highest score (equal to 6 places: the later term wins); 0 keeps all."""
    if k <= 0:
        return scores
    return scores.orderBy(F.desc(F.round("chi2", 6)), F.desc("term")).limit(k)


def chi2_from_matrix(observed: np.ndarray, class_counts: list[int]) -> np.ndarray:
    """Chi-square of every term from the class sums of a fitted model."""
    share = np.asarray(class_counts, dtype=float) / sum(class_counts)
    expected = np.outer(share, observed.sum(axis=0))
    with np.errstate(divide="ignore", invalid="ignore"):
        cells = (observed - expected) ** 2 / expected
    return np.where(expected > 0, cells, 0.0).sum(axis=0)


def best_positions(scores: np.ndarray, terms: list[str], k: int) -> list[int]:
    """Vector positions of the k best terms in rising order; all of them for k = 0 or a large k."""
    if k <= 0 or k >= len(terms):
        return list(range(len(terms)))
    ranked = sorted(range(len(terms)), key=lambda i: (round(float(scores[i]), 6), terms[i]), reverse=True)
    return sorted(ranked[:k])


def slice_vectors(vectors: DataFrame, positions: list[int], features: str, out: str) -> DataFrame:
    return VectorSlicer(inputCol=features, outputCol=out, indices=positions).transform(vectors)
