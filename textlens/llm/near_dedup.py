"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.llm.shared import KEY, flat_words, mix, ranges, slices, starts_of, stored, string_hashes, with_key, word_codes

#: Text bytes that a task turns into sketches at a time.
BATCH_BYTES = 2 << 20
#: Coordinates of a band and bands, at most and at least. Sets of similarity 0.85 miss all bands with probability 1e-6,
#: of 0.8 with 2e-4; for lower ones see `banding`.
ROWS, BANDS = 7, 36
#: Keys of sets to be verified are a broadcast up to this number (16 bytes each), a shuffle join beyond.
BROADCAST_KEYS = 1_000_000


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles, one text after the other, and their numbers.

    A text with some, but fewer than `size` words has one shingle, its whole sequence; a text without words has none.
    """
    flat, counts = flat_words(pc.ascii_lower(pc.fill_null(texts, "")))
    codes, distinct = word_codes(flat)
    hashes = string_hashes(distinct)[codes]
    starts = starts_of(counts)
    each = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), each)
    at = ranges(starts[:-1], each)
    long = (counts >= size)[owner]
    value = np.full(len(owner), 0, np.uint64)
    for k in range(size):
        inside = long | (k < counts[owner])
        value[inside] = mix(value[inside] ^ hashes[at[inside] + k], k)
    value[~long] = mix(value[~long], 99)  # a short sequence differs from every full shingle
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[fresh], np.bincount(owner[fresh], minlength=len(counts)).astype(np.int64)


def similarity_sketches(values: np.ndarray, counts: np.ndarray, t: int) -> np.ndarray:
    """A row of `t` coordinates for each set.

    In round i every element is hashed to a bin and a value, and each bin that is still empty takes the least value it
    gets. From round t on, all elements go to bin i - t, so that after 2t rounds every coordinate is filled; a set of
    n elements needs about (t log t) / n rounds. A coordinate of two sets agrees with probability equal to their
    similarity, with the concentration of independent trials.
    """
    sets = len(counts)
    sketch = np.zeros((sets, t), np.uint64)
    filled = np.zeros((sets, t), bool)
    owner = np.repeat(np.arange(sets), counts)
    live = counts > 0
    for i in range(2 * t):
        if not live.all():
            keep = live[owner]
            values, owner = values[keep], owner[keep]
        if not len(values):
            break
        h = mix(values, i + 1)
        cell = owner * t + ((h >> np.uint64(40)) % np.uint64(t)).astype(np.int64) if i < t else owner * t + (i - t)
        empty = ~filled.reshape(-1)[cell]
        cell, h = cell[empty], h[empty]
        least = np.full(sets * t, np.iinfo(np.uint64).max) if len(cell) > sets * t // 8 else None
        if least is not None:
            np.minimum.at(least, cell, h)
            got = np.unique(cell)
            sketch.reshape(-1)[got] = mix(least[got], 7 + i)
        else:
            order = np.lexsort((h, cell))
            cell, h = cell[order], h[order]
            first = np.ones(len(cell), bool)
            first[1:] = cell[1:] != cell[:-1]
            got = cell[first]
            sketch.reshape(-1)[got] = mix(h[first], 7 + i)
        filled.reshape(-1)[got] = True
        live = (counts > 0) & ~filled.all(axis=1)
        if not live.any():
            break
    return sketch


def band_hashes(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    out = np.zeros((len(sketch), bands), np.uint64)
    for k in range(rows):
        out = mix(out ^ sketch[:, k : rows * bands : rows], k)
    return mix(out ^ np.arange(bands, dtype=np.uint64), 31)


def banding(percent: int, miss: float) -> tuple[int, int]:
    """Coordinates of a band and bands: two sets of similarity `percent` share no band with probability `miss` at most.

    Bands get shorter and more numerous while the sketch keeps its length; only bands of one coordinate add to it.
    """
    if not 0 < percent <= 100 or not 0 < miss < 1:
        raise ValueError(f"percent {percent} is not in 1..100, or miss {miss} not between 0 and 1")
    for rows in range(ROWS, 0, -1):
        bands = ROWS * BANDS // rows
        if (1 - (percent / 100) ** rows) ** bands <= miss:
            return rows, bands
    return 1, math.ceil(math.log(miss) / math.log1p(-percent / 100))


def _sketched(docs: DataFrame, size: int, percent: int, miss: float) -> DataFrame:
    """Documents (key, doc_id) with n_shingles, set (16 bytes that identify the shingle set) and band hashes."""
    rows, bands_of = banding(percent, miss)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                values, counts = shingle_sets(part.column("text"), size)
                bands = band_hashes(similarity_sketches(values, counts, rows * bands_of), rows, bands_of).view(np.int64)
                owner = np.repeat(np.arange(len(counts)), counts)
                sums = np.zeros((len(counts), 2), np.uint64)
                for k in (0, 1):
                    np.add.at(sums[:, k], owner, mix(values, 50 + k))
                names = [x.tobytes() if n else None for x, n in zip(sums, counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", *KEY)),
                        pa.array(counts),
                        pa.array(names, pa.binary()),
                        pa.array([x if n else None for x, n in zip(bands, counts.tolist(), strict=True)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", *KEY, "n_shingles", "set", "bands"],
                )

    return docs.mapInArrow(run, f"doc_id {kind}, {KEY[0]} long, {KEY[1]} long, n_shingles long, set binary, bands array<long>")


def _packed_sets(docs: DataFrame, size: int) -> DataFrame:
    """Sets (node, shingles): sorted 64-bit hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                values, counts = shingle_sets(part.column("text"), size)
                bounds = starts_of(counts).tolist()
                cut = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(cut, pa.binary())], names=["node", "shingles"])

    return docs.mapInArrow(run, "node long, shingles binary")


def differences(p: np.ndarray, x: np.ndarray, percent: int) -> tuple[bool, np.ndarray, int]:
    """Whether sets p and x are linked, their difference (elements outside p by hash, then
    those of p), and how many of its first elements must hold one that a linked set shares.

    Let D(x) be the difference of x and p. Two sets x and y differ in D(x) ^ D(y); if they are linked, that has at most
    (100 - percent) / (100 + percent) of |x| + |y| elements, so D(x) and D(y) must share some if one of the two is not
    linked with p. In any order that is the same for all sets compared with p, they then share one of the first
    |D| - o + 1 elements, where o is a lower bound of how many they share.
    """
    new, lost = np.setdiff1d(x, p, assume_unique=True), np.setdiff1d(p, x, assume_unique=True)
    common, size = len(x) - len(new), len(new) + len(lost)
    linked = 100 * common >= percent * (len(x) + len(p) - common)
    if linked:  # the other one is not: it differs from p by more than (100 - percent) / (100 + percent) of both sizes
        shared = (size * (100 + percent) + (100 - percent) * (len(p) - len(x))) // (2 * (100 + percent)) + 1
    else:  # the other one's size is at most 100 / percent of this one's
        shared = size - len(x) * (100 - percent) // percent
    return linked, np.concatenate([new, lost]), size - max(1, shared) + 1


def compared(p: np.ndarray, x: np.ndarray, percent: int) -> tuple[bool, np.ndarray, int]:
    """Whether sets p and x are linked, the first elements of their difference, and its size.

    What is peculiar to a copy comes first, so copies of p that have nothing else in common share no such element.
    """
    linked, differ, first = differences(p, x, percent)
    return linked, differ[:first], len(differ)


def _may_link(percent: int, one: str, other: str) -> Column:
    """Whether two sets that share an element of their differences can be linked, if it is the first they share.

    They then share at most what follows in the shorter rest, and must share half of what the sizes of both
    differences exceed the difference that a link allows.
    """
    x, y = ({k: F.col(f"{k}_{side}") for k in ("size", "place", "n")} for side in (one, other))
    allowed = F.floor((x["n"] + y["n"]) * (100 - percent) / (100 + percent))
    return 2 * F.least(x["size"] - x["place"], y["size"] - y["place"]) >= x["size"] + y["size"] - allowed


def _comparison(percent: int):
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        found = [differences(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(a, b, strict=True)]
        columns = zip(*((linked, differ.view(np.int64), first, len(y) // 8) for (linked, differ, first), y in zip(found, b, strict=True)), strict=True)
        return pd.DataFrame(dict(zip(("linked", "differ", "first", "n"), map(list, columns), strict=False)), columns=["linked", "differ", "first", "n"])

    return F.pandas_udf(run, "linked boolean, differ array<long>, first long, n long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of links (a, b): the least node that can be reached.

    Labels spread along links and then jump to their label's label, so the rounds grow with the logarithm of the
    longest path. Each round is written to the shared folder.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        spread = stored(spread)
        up = spread.select(F.col("node").alias("label"), F.col("label").alias("upper"))
        jumped = stored(spread.join(up, "label", "left").select("node", "old", F.coalesce("upper", "label").alias("label")))
        labels = jumped.select("node", "label")
        if jumped.filter("old != label").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, miss: float = 2.1e-4) -> DataFrame:
    """A row for each document: doc_id, key, n_shingles, component_id, is_first.

    Documents whose sets of `size`-word shingles (A-Z in lower case, words between ASCII white space) have a
    similarity of at least `percent` per cent are linked; component_id is the least doc_id that links reach. is_first
    marks the rows of the one document of each component that comes first by doc_id, then key. Texts without words are
    linked with nothing; null ids come last; rows with equal doc_id and text are the same document. An empty table
    gives an empty result.

    Equal sets become one node, and nodes that share a band are candidates. Each band's nodes are compared with its
    pivot, the node that shares bands with most others, and links join components. Nodes of a band that are left in
    different components make finer bands: each differs from the pivot, and two of them can only be linked if they
    share one of the first elements of those differences, early enough (see `compared`, `_may_link`). Finer bands are
    compared with pivots of their own, and then all their pairs that are left and may be linked. So a large group costs a
    comparison for each of its members, and no pair that shares a band is left out. Every link is confirmed on the
    full sets. A pair of similarity `percent` shares no band, and is then not compared, with probability `miss` at most:
    bands follow from both, and a low `percent` makes more candidates.
    """
    keyed = with_key(docs.select("doc_id", "text"))
    sketched = stored(_sketched(keyed, size, percent, miss))
    ids = [F.col("doc_id").isNull(), F.col("doc_id"), *map(F.col, KEY)]
    least = F.min(F.struct(ids[0].alias("none"), *ids[1:])).alias("least")
    # The bands of a set are the same in all its documents.
    nodes = sketched.filter("set IS NOT NULL").groupBy("set").agg(least, F.first("bands").alias("bands"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()))
    rows = nodes.select("node", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("n_band")).filter("n_band > 1")
    members = stored(rows.join(shared, "band"))
    sets = _sets_of(keyed, nodes, members, size)
    pairs = stored(_compare(_pivot_pairs(members, None), sets, percent))
    links = stored(pairs.filter("c.linked").select("a", "b"))
    labels = components(links)
    finer = _finer_bands(pairs, labels)
    for candidates in (_pivot_pairs, _other_pairs):
        if finer.isEmpty():
            break
        found = _compare(candidates(finer, percent), sets, percent).filter("c.linked").select("a", "b")
        links = stored(links.union(found))
        labels = components(links)
        finer = _still_open(finer.drop("label", "n_band"), labels)
    grouped = nodes.select("set", "node", "least").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = grouped.groupBy("label").agg(F.min("least").alias("head"))
    heads = grouped.select("set", "label").join(heads, "label").select("set", "head")
    joined = sketched.drop("bands").join(heads, "set", "left")
    own = [F.col("head.doc_id").eqNullSafe(F.col("doc_id")), *(F.col(f"head.{k}") == F.col(k) for k in KEY)]
    first = F.col("set").isNull() | (own[0] & own[1] & own[2])
    component = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id"))
    return joined.select("doc_id", *KEY, "n_shingles", component.alias("component_id"), first.alias("is_first"))


def _sets_of(keyed: DataFrame, nodes: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """Full sets of all nodes that share a band, from one document of each."""
    wanted = members.select("node").distinct().join(nodes.select("node", *(F.col(f"least.{k}").alias(k) for k in KEY)), "node")
    wanted = stored(wanted)
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    # Repeated rows have one key; their sets are the same.
    return stored(_packed_sets(keyed.join(wanted, list(KEY)).select("node", "text"), size).groupBy("node").agg(F.first("shingles").alias("shingles")))


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    first = sets.withColumnsRenamed({"node": "a", "shingles": "x"})
    second = sets.withColumnsRenamed({"node": "b", "shingles": "y"})
    return pairs.join(first, "a").join(second, "b").select("a", "b", _comparison(percent)("x", "y").alias("c"))


def _pivot_pairs(members: DataFrame, percent: int | None) -> DataFrame:
    """Pairs (a: pivot, b: node) of bands; with `percent`, those that may be linked."""
    central = members.groupBy("node").agg(F.sum("n_band").alias("central"))
    order = F.struct("central", -F.col("node"))
    pivots = members.join(central, "node").groupBy("band").agg(F.max_by(F.struct(*members.columns), order).alias("p"))
    joined = members.join(pivots.select("band", "p"), "band").filter("node != p.node")
    if percent is not None:
        sides = {f"{k}_p": F.col(f"p.{k}") for k in ("size", "place", "n", "label")} | {f"{k}_x": F.col(k) for k in ("size", "place", "n")}
        joined = joined.withColumns(sides).filter(_may_link(percent, "p", "x") & (F.col("label") != F.col("label_p")))
    return joined.select(F.col("p.node").alias("a"), F.col("node").alias("b")).distinct()


def _other_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs of bands in different components that may be linked."""
    sides = [members.select("band", *(F.col(k).alias(f"{k}_{side}") for k in ("node", "size", "place", "n", "label"))) for side in ("x", "y")]
    apart = (F.col("node_x") < F.col("node_y")) & (F.col("label_x") != F.col("label_y"))
    joined = sides[0].join(sides[1], (sides[0]["band"] == sides[1]["band"]) & apart & _may_link(percent, "x", "y"))
    return joined.select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()


def _finer_bands(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Bands of the nodes of one pivot that share a first element of their differences and are not all in one component:
    band, node, n_band (members), label, place of the element, size of the difference, n (size of the set).

    Elements are ordered by the number of the pivot's nodes that differ from it by them, rare ones first, so an element
    that many share makes a band only for nodes with few others. Those of one node make none, but keep their place.
    """
    named = pairs.join(labels.withColumnRenamed("node", "b"), "b", "left").withColumn("label", F.coalesce("label", "b"))
    split = named.groupBy("a").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("a")
    differ = named.join(split, "a").select("a", F.col("b").alias("node"), F.size("c.differ").cast("long").alias("size"), "c.first", "c.n", F.explode("c.differ").alias("element"))
    often = differ.groupBy("a", "element").agg(F.count("*").alias("often")).filter("often > 1")
    own = Window.partitionBy("a", "node")
    rows = differ.join(often, ["a", "element"]).withColumn("place", F.row_number().over(own.orderBy("often", "element")) - 1 + F.col("size") - F.count("*").over(own))
    rows = rows.filter("place < first").select(F.xxhash64("a", "element").alias("band"), "node", "place", "size", "n")
    return _still_open(rows, labels)


def _still_open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of bands with nodes of more than one component, with labels and the number of the band's rows."""
    rows = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    bands = rows.groupBy("band").agg(F.count("*").alias("n_band"), F.min("label").alias("low"), F.max("label").alias("high"))
    return stored(rows.join(bands.filter("low != high").select("band", "n_band"), "band"))
