"""Access to ML vector columns without leaving the JVM."""

import numpy as np
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_values(c: str) -> Column:
    """Stored values of a vector (for a sparse one, the non-zero values)."""
    return F.unwrap_udt(c)["values"]


def vector_positions(c: str) -> Column:
    """Positions of the stored values of a vector."""
    raw = F.unwrap_udt(c)
    every = F.transform(raw["values"], lambda v, i: i)
    return F.when(raw["type"] == 0, raw["indices"]).otherwise(every)


def vector_entries(c: str) -> Column:
    """array<struct<position, value>> of the stored entries."""
    raw = F.unwrap_udt(c)
    sparse = F.arrays_zip(raw["indices"].alias("position"), raw["values"].alias("value"))
    dense = F.transform(
        raw["values"], lambda v, i: F.struct(i.alias("position"), v.alias("value"))
    )
    return F.when(raw["type"] == 0, sparse).otherwise(dense)


def squared_norm(c: str) -> Column:
    return F.aggregate(vector_values(c), F.lit(0.0), lambda acc, v: acc + v * v)


def with_dot_products(df: DataFrame, features: str, rows: np.ndarray, out: str) -> DataFrame:
    """Add ``out``: array<double> of the dot products of ``features`` with each row of ``rows``.

    A narrow transformation: the rows travel with the task closure, documents never move. ``rows``
    is a fitted model (classes or clusters by vocabulary), so its size does not grow with the data.
    """
    columns = df.columns
    names = [f"__product_{i}" for i in range(len(rows))]
    for name, row in zip(names, rows):
        df = ElementwiseProduct(
            scalingVec=DenseVector(np.asarray(row, dtype=float)), inputCol=features, outputCol=name
        ).transform(df)
    sums = [
        F.aggregate(vector_values(name), F.lit(0.0), lambda acc, v: acc + v) for name in names
    ]
    return df.select(*columns, F.array(*sums).alias(out))


def heaviest(weights: np.ndarray, terms: list[str], n: int, among: np.ndarray | None = None) -> list[int]:
    """Positions of the n largest weights by their value rounded to 6 places, of equal ones the first terms. Only those
    that reach the n-th value are sorted."""
    places = np.arange(len(weights)) if among is None else np.asarray(among, dtype=int)
    rounded = np.floor(weights[places] * 1e6 + 0.5)
    if 0 < n < len(places):
        least = np.partition(rounded, len(rounded) - n)[len(rounded) - n]
        places, rounded = places[rounded >= least], rounded[rounded >= least]
    order = sorted(range(len(places)), key=lambda i: (-rounded[i], terms[places[i]]))
    return [int(places[i]) for i in order[:n]]
