"""Similarity join of shingle sets: segments of a partitioned universe, one-deletion neighbourhoods, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlens.llm.near_dedup import BROADCAST_KEYS, compared, components, shingle_sets
from textlens.llm.shared import KEY, mix, slices, starts_of, stored, with_key

#: Text bytes that a task turns into segments at a time.
BATCH_BYTES = 2 << 20
#: A segment subset shared with more sets of other components than that is costly.
COSTLY = 8


class SizeBands:
    """Sizes in bands, each up to the largest size that can be linked with the band's least.

    In the index of a band are the sets of the band and those of the next one, so that each linked pair meets in the
    band of its smaller set. Sets of sizes a and b are linked if they differ in at most
    (100 - percent) (a + b) / (100 + percent) elements. The universe of a band is hashed into some more segments than
    the largest such difference, so linked sets have equal subsets in several of them.
    """

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError(f"percent {percent} is not in 50..100")
        self.percent = percent
        low = [1]
        while low[-1] < 1 << 40:
            low.append(low[-1] * 100 // percent + 1)
        self.low = np.array(low[:-1])
        self.high = np.array(low[1:]) - 1
        most = self.difference(self.high, self.high * 100 // percent)
        #: No segments where only equal sets are linked.
        self.segments = np.where(most > 0, most + 2 + most // 8, 0)

    def difference(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def place(self, sizes: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Band, number of segments, and how many of them a set may leave out, for sets in their own band or the one
        below (no segments where no link leads there)."""
        band = np.searchsorted(self.low, sizes, side="right") - 1
        largest = sizes * 100 // self.percent
        if lower:
            band = band - 1
            largest = np.where(band >= 0, self.high[band], 0)
        there = (sizes > 0) & (band >= 0) & (100 * largest >= self.percent * sizes)
        segments = np.where(there, self.segments[band], 0)
        return band, segments, np.maximum(segments - self.difference(sizes, largest) - 1, 0)


def _cells(values: np.ndarray, counts: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each element (sets have their segments one after the other), and where each set's cells begin."""
    first = starts_of(segments)
    m = np.repeat(segments, counts).astype(np.uint64)
    return np.repeat(first[:-1], counts) + (((values >> np.uint64(32)) * m) >> np.uint64(32)).astype(np.int64), first


def _names(band: np.ndarray, segment: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """A 64-bit name of a segment's subset, from the sum of its elements' hashes: one can be taken out by subtraction."""
    return mix(sums + mix((band.astype(np.uint64) << np.uint64(40)) | segment.astype(np.uint64), 71), 72)


def subset_names(values: np.ndarray, counts: np.ndarray, band: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the subsets of all sets, and where each set's begin. Elements are sorted, so segments are runs of them."""
    cell, first = _cells(values, counts, segments)
    live = np.repeat(segments > 0, counts)
    cell, hashes = cell[live], mix(values[live], 70)
    total = int(first[-1])
    ends = np.searchsorted(cell, np.arange(total), side="right")
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes, dtype=np.uint64)])
    sums = sums[ends] - sums[np.concatenate([[0], ends[:-1]])] if total else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(counts)), segments)
    return _names(band[owner], np.arange(total) - first[owner], sums), first


def _segmented(docs: DataFrame, size: int, bands: SizeBands) -> DataFrame:
    """Documents (doc_id, key) with n_shingles, set (16 bytes that identify the shingle set), names of subsets in the own
    and the lower band, and the number of them that can be left out."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                values, counts = shingle_sets(part.column("text"), size)
                owner = np.repeat(np.arange(len(counts)), counts)
                sums = np.zeros((len(counts), 2), np.uint64)
                for k in (0, 1):
                    np.add.at(sums[:, k], owner, mix(values, 50 + k))
                names = [x.tobytes() if n else None for x, n in zip(sums, counts.tolist(), strict=True)]
                columns = [*(part.column(c) for c in ("doc_id", *KEY)), pa.array(counts), pa.array(names, pa.binary())]
                for lower in (False, True):
                    band, segments, spare = bands.place(counts, lower)
                    found, first = subset_names(values, counts, band, segments)
                    columns += [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(found.view(np.int64))), pa.array(spare, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *KEY, "n_shingles", "set", "own", "own_spare", "lower", "lower_spare"])

    return docs.mapInArrow(run, f"doc_id {kind}, {KEY[0]} long, {KEY[1]} long, n_shingles long, set binary, own array<long>, own_spare int, lower array<long>, lower_spare int")


def _may_have_links(rows: DataFrame) -> DataFrame:
    """Rows (name, node, lower, spare) of subsets that several sets have, of sets with more of them than they can leave
    out. A linked pair has that many subsets in common, and both keep them, so the filter can be repeated."""
    several = rows.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name")
    rows = stored(rows.join(several, "name"))
    enough = rows.groupBy("node", "lower").agg(F.count("*").alias("n"), F.first("spare").alias("least")).filter("n > least")
    return rows.join(enough.select("node", "lower"), ["node", "lower"], "left_semi")


def _full_sets(keyed: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, shingles): sorted 64-bit hashes as bytes, made again from one document of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                values, counts = shingle_sets(part.column("text"), size)
                bounds = starts_of(counts).tolist()
                cut = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(cut, pa.binary())], names=["node", "shingles"])

    chosen = stored(wanted.select("node").distinct().join(nodes.select("node", *(F.col(f"least.{k}").alias(k) for k in KEY)), "node"))
    if chosen.count() <= BROADCAST_KEYS:
        chosen = F.broadcast(chosen)
    texts = keyed.join(chosen, list(KEY)).select("node", "text")
    return stored(texts.mapInArrow(run, "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles")))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are linked."""

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y, strict=True):
            one, other = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            common = len(np.intersect1d(one, other, assume_unique=True))
            out.append(100 * common >= percent * (len(one) + len(other) - common))
        return pd.Series(out, dtype=bool)

    first = sets.withColumnsRenamed({"node": "a", "shingles": "x"})
    second = sets.withColumnsRenamed({"node": "b", "shingles": "y"})
    return pairs.join(first, "a").join(second, "b").filter(similar("x", "y")).select("a", "b")


def _unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pivots(rows: DataFrame) -> DataFrame:
    """(name, a): one set of each subset, the one with most such rows."""
    central = rows.groupBy("node").agg(F.count("*").alias("central"))
    return rows.join(central, "node").groupBy("name").agg(F.max_by("node", F.struct("central", -F.col("node"))).alias("a"))


def _with_pivots(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    return rows.join(pivots, "name").filter("a != node").select("a", F.col("node").alias("b"))


def _open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of subsets whose sets lie in several components, with label, main (the label of most of the subset's sets)
    and cost: the sets of other components."""
    rows = rows.drop("label", "main", "cost").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    each = rows.groupBy("name", "label").agg(F.count("*").alias("same"))
    every = each.groupBy("name").agg(F.sum("same").alias("every"), F.max(F.struct("same", "label")).alias("main"), F.count("*").alias("n")).filter("n > 1")
    found = rows.join(each, ["name", "label"]).join(every, "name")
    return stored(found.select("name", "node", "lower", "spare", "label", F.col("main.label").alias("main"), (F.col("every") - F.col("same")).alias("cost")))


def _tighter(rows: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Open rows with what can be left out for the sizes there are: a node's largest difference to a link follows from
    the largest set that shares an open subset with it, not from the largest that might."""
    nodes = rows.select("node").distinct()
    if nodes.count() <= BROADCAST_KEYS:
        nodes = F.broadcast(nodes)
    known = stored(sizes.join(nodes, "node"))
    sized = rows.join(known, "node")
    largest = sized.groupBy("name").agg(F.max("n_shingles").alias("largest"))
    reach = sized.join(largest, "name").groupBy("node", "lower").agg(
        F.max("largest").alias("largest"), F.first("n_shingles").alias("n"), F.first(F.when(F.col("lower"), F.col("lower_own")).otherwise(F.col("own"))).alias("segments")
    )
    partner = F.least("largest", F.floor(F.col("n") * 100 / percent))
    most = F.floor((100 - percent) * (F.col("n") + partner) / (100 + percent))
    reach = reach.select("node", "lower", (F.col("segments") - most - 1).cast("int").alias("spare"))
    return rows.drop("spare").join(reach, ["node", "lower"]).select(rows.columns)


def _partners(probes: DataFrame, rows: DataFrame, on: str = "name") -> DataFrame:
    other = rows.select(on, F.col("node").alias("b"), F.col("label").alias("_other"))
    return probes.join(other, on).filter(F.col("label") != F.col("_other")).select(F.col("node").alias("a"), "b")


def _cheap_pairs(probes: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs of probes (cost at most COSTLY) with the sets of other components. Those of the main component meet the
    few rows outside it, and a subset in which others are cheap has at most 2 COSTLY rows, so each probe meets few."""
    of_main = F.col("label") == F.col("main")
    return _partners(probes.filter(of_main), rows.filter(~of_main)).union(_partners(probes.filter(~of_main), rows))


def _neighbourhoods(sets: DataFrame, bands: SizeBands) -> DataFrame:
    """Rows of sets (node, lower, label, shingles): place of a segment, its name, and names without one element (cut)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                node, lower, label, raw = (batch.column(c)[k].as_py() for c in ("node", "lower", "label", "shingles"))
                values = np.frombuffer(raw, np.uint64)
                counts = np.array([len(values)])
                band, segments, _ = bands.place(counts, lower)
                m = int(segments[0])
                hashes, cell = mix(values, 70), _cells(values, counts, segments)[0]
                sums = np.zeros(m, np.uint64)
                np.add.at(sums, cell, hashes)
                whole = _names(np.full(m, band[0]), np.arange(m), sums)
                cut = _names(np.full(len(values), band[0]), cell, sums[cell] - hashes)
                size = m + len(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, node)),
                        pa.array([lower] * size, pa.bool_()),
                        pa.array(np.full(size, label)),
                        pa.array(np.concatenate([np.arange(m), cell]), pa.int64()),
                        pa.array(np.concatenate([whole, cut]).view(np.int64)),
                        pa.array(np.arange(size) >= m),
                    ],
                    names=["node", "lower", "label", "place", "name", "cut"],
                )

    return sets.mapInArrow(run, "node long, lower boolean, label long, place long, name long, cut boolean")


def _raised(costly: DataFrame, probes: DataFrame, rows: DataFrame, sets: DataFrame, bands: SizeBands) -> tuple[DataFrame, DataFrame]:
    """Other segments in place of costly ones: pairs to compare, and the costly probes that are left.

    Linked sets with an equal subset in no allocated segment but the costly ones differ by one element at most in
    another one, if that is raised. A set raises its cheapest segments, as many as it has costly ones, if no more than
    COSTLY sets lie in their one-deletion neighbourhood. Only sets with costly probes need that: a pair with any other
    set is found by the other one.
    """
    short = costly.groupBy("node", "lower").agg(F.count("*").alias("short"), F.first("label").alias("label"))
    near = stored(_neighbourhoods(short.join(sets, "node").select("node", "lower", "label", "shingles"), bands))
    # An element fewer here or there: names without an element against whole ones of the other sets.
    each = near.groupBy("name", "label", "cut").agg(F.count("*").alias("same"))
    every = each.groupBy("name", "cut").agg(F.sum("same").alias("every"))
    sides = [x.withColumn("side", ~F.col("cut")).drop("cut") for x in (every, each)]
    facing = near.withColumn("side", F.col("cut")).join(sides[0], ["name", "side"], "left").join(sides[1], ["name", "label", "side"], "left")
    others = F.coalesce("every", F.lit(0)) - F.coalesce("same", F.lit(0))
    facing = stored(facing.select("node", "lower", "label", "place", "name", "cut", others.alias("others")))
    costs = facing.groupBy("node", "lower", "place").agg(F.sum("others").alias("cost"), F.max(F.when(~F.col("cut"), F.col("name"))).alias("name"))
    # Open segments that are not probed cheaply can't be raised: their equal subsets are not looked at.
    closed = rows.select("node", "lower", "name").subtract(probes.select("node", "lower", "name"))
    may = costs.join(closed, ["node", "lower", "name"], "left_anti").filter(F.col("cost") <= COSTLY)
    cheapest = Window.partitionBy("node", "lower").orderBy("cost", "place")
    chosen = may.withColumn("nth", F.row_number().over(cheapest)).join(short.select("node", "lower", "short"), ["node", "lower"]).filter("nth <= short")
    chosen = stored(chosen.select("node", "lower", "place"))
    raised = facing.filter("others > 0").join(chosen, ["node", "lower", "place"], "left_semi")
    pairs = _partners(raised.filter("cut"), near.filter("NOT cut")).union(_partners(raised.filter("NOT cut"), near.filter("cut")))
    relieved = chosen.groupBy("node", "lower").agg(F.count("*").alias("relief"))
    dearest = Window.partitionBy("node", "lower").orderBy(F.desc("cost"), "name")
    left = costly.withColumn("nth", F.row_number().over(dearest)).join(relieved, ["node", "lower"], "left").filter("nth > coalesce(relief, 0)")
    return pairs, stored(left.select(costly.columns))


def jaccard_join(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """A row for each document: doc_id, key, n_shingles, component_id.

    Documents whose sets of `size`-word shingles (A-Z in lower case, words between ASCII white space; a shorter text is
    one shingle) have a similarity of `percent` (50 to 100) or more are linked; component_id is the least doc_id that
    links reach. Every link counts: the result is exact up to 64-bit hashes of shingles. Texts without words are linked
    with nothing; null ids come last; rows with equal doc_id and text are one document; an empty table gives an empty
    result. Long texts are sets like others.

    Equal sets become one node. Sets are cut into subsets by the segments of their size band and the one below (see
    `SizeBands`). Nodes that share too few subsets with others drop out. Each shared subset's nodes are compared with one
    of them, so that copies, however many, join components at a comparison each. Where a subset still has several
    components, it costs a node as many comparisons as the subset has nodes of other components. A node needs one more
    segment than a link's largest difference, and takes its cheapest; in place of costly ones it raises others to
    differences of one element (`_raised`). In subsets that are costly even so, nodes meet by what they differ in from
    the subset's pivot (`_near_a_pivot`).
    """
    bands = SizeBands(percent)
    keyed = with_key(docs.select("doc_id", "text"))
    segmented = stored(_segmented(keyed, size, bands).withColumn("row", F.monotonically_increasing_id()))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEY, "row")).alias("least")
    # A node goes by the row of its least document, whose subsets stand for it.
    nodes = stored(segmented.filter("set IS NOT NULL").groupBy("set").agg(least).withColumn("node", F.col("least.row")))
    chosen = nodes.select("node")
    if nodes.count() <= BROADCAST_KEYS:
        chosen = F.broadcast(chosen)
    lists = segmented.join(chosen, segmented["row"] == chosen["node"])
    rows = lists.select("node", F.size("own").alias("n_own"), "own_spare", "lower_spare", F.posexplode(F.concat("own", "lower")).alias("at", "name"))
    low = F.col("at") >= F.col("n_own")
    rows = rows.select("name", "node", low.alias("lower"), F.when(low, F.col("lower_spare")).otherwise(F.col("own_spare")).alias("spare"))
    rows = stored(_may_have_links(_may_have_links(rows)))
    sets = _full_sets(keyed, nodes, rows, size)
    pivots = stored(_pivots(rows))
    links = stored(_linked(_unordered(_with_pivots(rows, pivots)), sets, percent))
    labels = components(links)
    rows = _open(rows, labels)
    if not rows.isEmpty():
        sizes = segmented.select(F.col("row").alias("node"), "n_shingles", F.size("own").alias("own"), F.size("lower").alias("lower_own"))
        rows = stored(_tighter(rows, sizes, percent))
        labels = _joined(rows, pivots, links, sets, bands)
    grouped = nodes.select("set", "node", "least").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = grouped.groupBy("label").agg(F.min("least").alias("head"))
    heads = grouped.select("set", "label").join(heads, "label").select("set", F.col("head.doc_id").alias("_first"))
    component = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("_first"))
    return segmented.join(heads, "set", "left").select("doc_id", *KEY, "n_shingles", component.alias("component_id"))


def _probes(rows: DataFrame) -> DataFrame:
    """A node's cheapest open rows, all but those it can leave out."""
    by_node = Window.partitionBy("node", "lower")
    counted = rows.withColumn("nth", F.row_number().over(by_node.orderBy("cost", "name"))).withColumn("n", F.count("*").over(by_node))
    return counted.filter("nth <= n - spare").drop("nth", "n")


def _near_a_pivot(left: DataFrame, rows: DataFrame, pivots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of costly probes that are left with sets of other components.

    The subsets whose pivots lie in one component share the pivot of most of them, so that a set meets few. Its sets are
    compared with it. Two sets that are not both linked with it can only be linked with each other if they share one of
    the first elements of their differences to it, those peculiar to the set first (see `compared`). So pairs meet by
    pivot and such an element, not by subset, and only where enough elements can follow.
    """

    @F.pandas_udf("first array<long>, size long, n long")
    def difference(p: pd.Series, x: pd.Series) -> pd.DataFrame:
        found = [compared(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in zip(p, x, strict=True)]
        return pd.DataFrame({"first": [f.view(np.int64) for _, f, _ in found], "size": [n for _, _, n in found], "n": [len(b) // 8 for b in x]}, columns=["first", "size", "n"])

    labels = rows.select("node", "label").distinct()
    named = left.select("name").distinct().join(pivots, "name").join(labels.withColumnsRenamed({"node": "a", "label": "_of"}), "a", "left").withColumn("_of", F.coalesce("_of", "a"))
    shared = named.groupBy("_of", "a").agg(F.count("*").alias("n")).groupBy("_of").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("pivot"))
    pivots = stored(named.join(shared, "_of").select("name", F.col("pivot").alias("a"), "_of"))
    labels = labels.withColumnRenamed("node", "b")
    groups = _with_pivots(rows.join(pivots.select("name"), "name", "left_semi"), pivots.select("name", "a")).distinct()
    probing = _with_pivots(left, pivots.select("name", "a")).distinct().withColumn("probes", F.lit(True))
    groups = stored(groups.join(probing, ["a", "b"], "left").join(labels, "b"))
    with_pivot = groups.join(pivots.select("a", "_of").distinct(), "a").filter(F.col("label") != F.col("_of")).select("a", "b")
    first, second = (sets.withColumnsRenamed({"node": c, "shingles": f"set_{c}"}) for c in "ab")
    parts = groups.join(first, "a").join(second, "b").select("a", "b", "label", "probes", difference("set_a", "set_b").alias("d"))
    parts = stored(parts.select("a", "b", "label", "probes", "d.size", "d.n", F.posexplode("d.first").alias("at", "element")))
    x, y = (parts.select("a", "element", *(F.col(c).alias(f"{c}_{side}") for c in ("b", "label", "probes", "size", "n", "at"))) for side in "xy")
    allowed = F.floor((F.col("n_x") + F.col("n_y")) * (100 - percent) / (100 + percent))
    enough = 2 * F.least(F.col("size_x") - F.col("at_x"), F.col("size_y") - F.col("at_y")) >= F.col("size_x") + F.col("size_y") - allowed
    # A pair of probes is met once; other sets are met by probes only.
    once = F.col("probes_y").isNull() | (F.col("b_x") < F.col("b_y"))
    met = x.filter("probes_x").join(y, ["a", "element"]).filter((F.col("label_x") != F.col("label_y")) & once & enough)
    return met.select(F.col("b_x").alias("a"), F.col("b_y").alias("b")).union(with_pivot)


def _joined(rows: DataFrame, pivots: DataFrame, links: DataFrame, sets: DataFrame, bands: SizeBands) -> DataFrame:
    """Components of the links and those found in open rows."""
    probes = stored(_probes(rows))
    cheap, left = probes.filter(F.col("cost") <= COSTLY), probes.filter(F.col("cost") > COSTLY)
    pairs = _cheap_pairs(cheap, rows)
    if not left.isEmpty():
        more, left = _raised(left, cheap, rows, sets, bands)
        pairs = pairs.union(more)
        if not left.isEmpty():
            pairs = pairs.union(_near_a_pivot(left, rows, pivots, sets, bands.percent))
    return components(stored(links.union(_linked(_unordered(pairs), sets, bands.percent))))
