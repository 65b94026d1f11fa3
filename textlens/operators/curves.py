"""Precision-recall and ROC curves, average precision and area under the ROC curve.

Rows are first counted per distinct score, and the distinct scores are dealt to partitions by ranges. Every task adds up
its own range; the few totals of ranges, summed over the ranges above, shift what it found. So no task sees the whole
curve, no bounds are collected, and distinct scores move once.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STEPS = "range int, score double, hits long, misses long, tp long, fp long, step long, next_hits long, next_misses long"


@dataclass
class Curve:
    """``steps``: one row per distinct score with tp and fp, the counts at or above that score."""

    steps: DataFrame

    def precision_recall(self) -> DataFrame:
        """(point, x, y, threshold) with rising thresholds; the last point has none."""
        recall = F.when(F.col("positives") > 0, F.col("tp") / F.col("positives")).otherwise(F.lit(1.0))
        points = self.steps.select(
            (F.col("n_steps") - F.col("step")).alias("point"),
            recall.alias("x"),
            (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("y"),
            F.col("score").alias("threshold"),
        )
        closing = self.steps.filter(F.col("step") == 1).select(
            F.col("n_steps").alias("point"),
            F.lit(0.0).alias("x"),
            F.lit(1.0).alias("y"),
            F.lit(None).cast("double").alias("threshold"),
        )
        return points.unionByName(closing)

    def roc(self) -> DataFrame:
        """(point, x, y, threshold) from (0, 0) with an infinite threshold; points inside a straight
        stretch are left out. A rate of a class without rows is null."""
        steps = self.steps.filter(
            (F.col("step") == F.col("n_steps"))
            | (F.col("n_steps") <= 2)
            | (F.col("hits") != F.col("next_hits"))
            | (F.col("misses") != F.col("next_misses"))
            | (F.col("step") == 1)
        )
        kept = _numbered(steps, "kept")
        points = kept.select(
            F.col("kept").alias("point"),
            F.try_divide("fp", "negatives").alias("x"),
            F.try_divide("tp", "positives").alias("y"),
            F.col("score").alias("threshold"),
        )
        origin = self.steps.filter(F.col("step") == 1).select(
            F.lit(0).cast("long").alias("point"),
            F.lit(0.0).alias("x"),
            F.lit(0.0).alias("y"),
            F.lit(float("inf")).alias("threshold"),
        )
        return origin.unionByName(points)

    def metrics(self) -> DataFrame:
        """One row: average_precision, roc_auc, prevalence. Every step brings its own share of each,
        so plain sums suffice and no step needs its neighbours. Without rows of the target class, or without
        others, what needs them is null."""
        precision = F.col("tp") / (F.col("tp") + F.col("fp"))
        gain = F.try_divide("hits", "positives")
        width = F.try_divide("misses", "negatives")
        height = F.try_divide(2 * F.col("tp") - F.col("hits"), 2 * F.col("positives"))
        return self.steps.agg(
            F.sum(gain * precision).alias("average_precision"),
            F.sum(width * height).alias("roc_auc"),
            (F.sum("hits") / F.sum(F.col("hits") + F.col("misses"))).alias("prevalence"),
        )


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (score, hits, misses) of one range by falling score, with counts so far and the next row's hits and misses
    (null in the last row)."""
    number = TaskContext.get().partitionId()
    tp = fp = step = 0
    held: list[np.ndarray] | None = None

    def rows(columns: list[np.ndarray], after: tuple[int, int] | None) -> pa.RecordBatch:
        score, hits, misses = columns
        ahead = [pa.array([*x[1:].tolist(), None if after is None else after[k]], pa.int64()) for k, x in enumerate((hits, misses))]
        counts = (tp + np.cumsum(hits), fp + np.cumsum(misses), step + 1 + np.arange(len(score)))
        fixed = [pa.array(np.full(len(score), number, np.int32)), pa.array(score), pa.array(hits), pa.array(misses)]
        return pa.RecordBatch.from_arrays([*fixed, *map(pa.array, counts), *ahead], names=[x.split()[0] for x in STEPS.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("score", "hits", "misses")]
        if held is not None:
            yield rows(held, (int(columns[1][0]), int(columns[2][0])))
            tp, fp, step = tp + int(held[1].sum()), fp + int(held[2].sum()), step + len(held[0])
        held = columns
    if held is not None:
        yield rows(held, None)


def _range_totals(steps: DataFrame) -> DataFrame:
    """Per score range: its totals summed over the ranges above, and the first step of the next one."""
    ranges = steps.groupBy("range").agg(
        F.sum("hits").alias("range_hits"),
        F.sum("misses").alias("range_misses"),
        F.count(F.lit(1)).alias("range_steps"),
        F.min_by(F.struct("hits", "misses"), "step").alias("top"),
    )
    # Ranges are numbered by falling score.
    above = Window.partitionBy().orderBy("range")
    before = above.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # One row per range, that is per partition, so one task is enough here.
    return ranges.select(
        "range",
        F.coalesce(F.sum("range_hits").over(before), F.lit(0)).alias("hits_above"),
        F.coalesce(F.sum("range_misses").over(before), F.lit(0)).alias("misses_above"),
        F.coalesce(F.sum("range_steps").over(before), F.lit(0)).alias("steps_above"),
        F.sum("range_hits").over(everything).alias("positives"),
        F.sum("range_misses").over(everything).alias("negatives"),
        F.sum("range_steps").over(everything).alias("n_steps"),
        F.lead("top").over(above).alias("next_top"),
    )


def _numbered(steps: DataFrame, out: str) -> DataFrame:
    """Number rows by falling score from 1. The rows lie in their ranges already: each task counts its own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, found = None, 0
        for batch in batches:
            ranges = batch.column("range").to_numpy()
            for low, high in zip(cuts := [0, *np.flatnonzero(np.diff(ranges)) + 1], [*cuts[1:], len(ranges)], strict=True):
                if high > low:
                    if ranges[low] != current:
                        current, found = ranges[low], 0
                    yield batch.slice(low, high - low).append_column(out, pa.array(found + 1 + np.arange(high - low)))
                    found += high - low

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in steps.schema)
    sizes = steps.groupBy("range").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy().orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    counted = steps.mapInArrow(count, f"{columns}, `{out}` long")
    return counted.join(F.broadcast(sizes), "range").withColumn(out, F.col(out) + F.col("__before")).drop("__before")


def curve(
    scored: DataFrame, target: str = "negative", label: str = "label", score: str = "target_score", ranges: int | None = None
) -> Curve:
    """Running counts of target and other rows by falling score, in `ranges` ranges (Spark's choice by size if None)."""
    is_target = F.col(label) == target
    per_score = scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(is_target).alias("hits"), F.count_if(~is_target).alias("misses")
    )
    falling = F.desc("score")
    dealt = per_score.repartitionByRange(falling) if ranges is None else per_score.repartitionByRange(ranges, falling)
    # Kept, as the totals and the curve have to see the same ranges, in the same order.
    steps = dealt.sortWithinPartitions(falling).mapInArrow(_running, STEPS).persist(StorageLevel.MEMORY_AND_DISK)
    result = (
        steps.join(F.broadcast(_range_totals(steps)), "range")
        .withColumns(
            {
                "tp": F.col("tp") + F.col("hits_above"),
                "fp": F.col("fp") + F.col("misses_above"),
                "step": F.col("step") + F.col("steps_above"),
                "next_hits": F.coalesce("next_hits", "next_top.hits"),
                "next_misses": F.coalesce("next_misses", "next_top.misses"),
            }
        )
        .drop("hits_above", "misses_above", "steps_above", "next_top")
    )
    return Curve(result)


def curve_metrics(scored: dict[str, DataFrame], target: str = "negative", label: str = "label") -> DataFrame:
    """(model, average_precision_<target>, roc_auc_<target>, <target>_prevalence) per model."""
    result = None
    for name, rows in scored.items():
        row = curve(rows, target, label).metrics().select(
            F.lit(name).alias("model"),
            F.col("average_precision").alias(f"average_precision_{target}"),
            F.col("roc_auc").alias(f"roc_auc_{target}"),
            F.col("prevalence").alias(f"{target}_prevalence"),
        )
        result = row if result is None else result.unionByName(row)
    return result


def curve_points(scored: dict[str, DataFrame], target: str = "negative", label: str = "label") -> DataFrame:
    """(curve, model, point, x, y, threshold) of both curves of every model."""
    result = None
    for name, rows in scored.items():
        steps = curve(rows, target, label)
        for kind, points in (("precision_recall", steps.precision_recall()), ("roc", steps.roc())):
            tagged = points.select(F.lit(kind).alias("curve"), F.lit(name).alias("model"), "*")
            result = tagged if result is None else result.unionByName(tagged)
    return result
