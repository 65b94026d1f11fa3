"""Exact-size sampling and stratified splitting by a hash of the row id.

Both draw the rows with the smallest hash values. The cut-off hash is found first, from counts of hash
prefixes, so that the draw itself is a plain filter: no sort, no window, no row of text moves.
"""

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most this many keys per class are brought to the driver to find the exact cut-off.
KEYS_ON_DRIVER = 10_000
PREFIX_STEP = 3


def hash_key(id_column: str = "doc_id", seed: int = 42) -> Column:
    return F.md5(F.concat_ws(":", F.col(id_column).cast("string"), F.lit(str(seed))))


@dataclass(frozen=True)
class Cut:
    """Of a group, all rows with a smaller key are drawn, and ``take`` of the ``have`` rows with this key."""

    key: str
    take: int
    have: int


def content_key(columns: list[str]) -> Column:
    """128 bits over all columns of a row; a null differs from every value."""
    parts = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.concat(*(F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts))))


def smallest_key_cuts(keys: DataFrame, counts: dict[str, int], quotas: dict[str, int]) -> dict[str, Cut]:
    """Per group, the hash key of the quota-th smallest row of ``keys`` (columns grp, key).

    Counts per hash prefix narrow the search until a group has few keys left under its prefix, or only
    equal ones. Equal keys are counted, not brought to the driver.
    """
    prefix = {g: "" for g in quotas}
    size = dict(counts)
    want = dict(quotas)
    open_groups = [g for g in quotas if 0 < quotas[g] and size[g] > KEYS_ON_DRIVER]
    while open_groups:
        depth = len(prefix[open_groups[0]]) + PREFIX_STEP
        scope = _any_of((F.col("grp") == g) & F.col("key").startswith(prefix[g]) for g in open_groups)
        table = (
            keys.filter(scope)
            .groupBy("grp", F.substring("key", 1, depth).alias("prefix"))
            .count()
            .collect()
        )
        for g in open_groups:
            for row in sorted((r for r in table if r["grp"] == g), key=lambda r: r["prefix"]):
                if want[g] <= row["count"]:
                    prefix[g], size[g] = row["prefix"], row["count"]
                    break
                want[g] -= row["count"]
        open_groups = [g for g in open_groups if size[g] > KEYS_ON_DRIVER and len(prefix[g]) < 32]
    drawn = [g for g in quotas if quotas[g] > 0]
    cuts = {g: Cut(prefix[g], want[g], size[g]) for g in drawn if len(prefix[g]) >= 32}
    searched = [g for g in drawn if g not in cuts]
    if not searched:
        return cuts
    scope = _any_of((F.col("grp") == g) & F.col("key").startswith(prefix[g]) for g in searched)
    rest = keys.filter(scope).groupBy("grp", "key").count().collect()
    for g in searched:
        for row in sorted((r for r in rest if r["grp"] == g), key=lambda r: r["key"]):
            if want[g] <= row["count"]:
                cuts[g] = Cut(row["key"], want[g], row["count"])
                break
            want[g] -= row["count"]
    return cuts


def _draw(df: DataFrame, flag: str, group: Column, key: Column, cuts: dict[str, Cut]) -> DataFrame:
    """Add ``flag``: whether a row is drawn. Equal keys are told apart by the rows' content; rows that are
    equal altogether are one row and a number, so any of them serve."""
    columns = df.columns
    below = _any_of((group == g) & ((key <= c.key) if c.take == c.have else (key < c.key)) for g, c in cuts.items())
    tied = {g: c for g, c in cuts.items() if c.take < c.have}
    flagged = df.withColumn(flag, below)
    if not tied:
        return flagged
    at_cut = _any_of((group == g) & (key == c.key) for g, c in tied.items())
    result = flagged.filter(~at_cut)
    content = content_key(columns)
    for g, c in tied.items():
        rows = df.filter((group == g) & (key == c.key))
        keys = rows.select(F.lit(g).alias("grp"), content.alias("key"))
        cut = smallest_key_cuts(keys, {g: c.have}, {g: c.take})[g]
        result = result.unionByName(rows.filter(content != cut.key).withColumn(flag, content < cut.key))
        equal = rows.filter(content == cut.key).limit(1)
        copies = equal.withColumn(flag, F.explode(F.transform(F.sequence(F.lit(1), F.lit(cut.have)), lambda i: i <= cut.take)))
        result = result.unionByName(copies)
    return result


def _any_of(conditions) -> Column:
    conditions = list(conditions)
    result = conditions[0]
    for c in conditions[1:]:
        result = result | c
    return result


def exact_sample(df: DataFrame, n: int | None, seed: int = 42, id_column: str = "doc_id") -> DataFrame:
    """Exactly ``n`` rows; the whole table if it has no more than that."""
    if n is None:
        return df
    if n <= 0:
        return df.filter(F.lit(False))
    total = df.select(id_column).count()
    if n >= total:
        return df
    keys = df.select(F.lit("all").alias("grp"), hash_key(id_column, seed).alias("key"))
    cuts = smallest_key_cuts(keys, {"all": total}, {"all": n})
    drawn = _draw(df, "__drawn", F.lit("all"), hash_key(id_column, seed), cuts)
    return drawn.filter("__drawn").drop("__drawn")


def split_quotas(class_counts: dict[str, int], test_size: float = 0.2) -> dict[str, int]:
    """Test rows per class: the overall share is exact, left-over rows go by largest remainder."""
    total = sum(class_counts.values())
    n_test = math.ceil(test_size * total)
    n_train = total - n_test
    if min(class_counts.values()) < 2:
        raise ValueError("Every class needs at least two rows for a stratified split.")
    if n_train < len(class_counts) or n_test < len(class_counts):
        raise ValueError("Train and test part need at least one row per class.")
    share = {c: Fraction(n_train * k, total) for c, k in class_counts.items()}
    train = {c: math.floor(s) for c, s in share.items()}
    left = n_train - sum(train.values())
    by_remainder = sorted(share, key=lambda c: (train[c] - share[c], c))
    for c in by_remainder[:left]:
        train[c] += 1
    return {c: class_counts[c] - train[c] for c in class_counts}


def stratified_split(
    df: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    label: str = "label",
    id_column: str = "doc_id",
) -> tuple[DataFrame, dict[str, int]]:
    """Add ``is_test`` (exact share per class); also returns the rows per class."""
    keys = df.select(F.col(label).alias("grp"), hash_key(id_column, seed).alias("key")).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        counts = {r["grp"]: r["count"] for r in keys.groupBy("grp").count().collect()}
        if not counts:
            raise ValueError("There are no rows to split.")
        cuts = smallest_key_cuts(keys, counts, split_quotas(counts, test_size))
    finally:
        keys.unpersist()
    split = _draw(df, "is_test", F.col(label), hash_key(id_column, seed), cuts)
    return split, dict(sorted(counts.items()))
