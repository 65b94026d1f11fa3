"""Regularised linear models on document vectors, fitted by L-BFGS.

Training rows are packed once into blocks of compressed sparse rows, a few binary cells each, and kept on disk; a step reads
these and converts nothing. Every step sums loss and gradient over all rows for all models that still move, whatever
their loss and selected terms: each partition returns one small array, Spark adds these up and the driver gets one. Blocks are read by one
task a core, so these arrays do not grow with the table. The driver only holds arrays of model size. Directions are
scaled by the squared weights of each term: frequent terms curve the objective by the number of rows, rare ones hardly. MLlib has no squared hinge loss, and its logistic regression standardises the columns internally,
which for rare terms takes many times more passes over the data than the plain TF-IDF weights need.
"""

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to this many partial sums are added up by one task; of more, groups are added up first. The driver gets one array.
DIRECT_PARTS = 32
# Pairs of steps that a search remembers: two arrays of model size each.
MEMORY = 20
# The curvature at the end is taken as this share of the loss's largest: most rows lie beyond the margin by then.
CURVED = 0.2
# Entries (position, weight) of a block, up to twice as many: 10 bytes each, 12 beyond 65,536 positions. Cells of some
# hundred KB fit between others on an executor's heap; those of many MB need a run of free memory and are copied often.
BLOCK_ENTRIES = 30_000
# Entries that a pass works on at a time: blocks of a batch are put together up to so many.
PASS_ENTRIES = 1 << 20
BLOCK = "targets binary, ends binary, positions binary, weights binary"


def squared_hinge(margins: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss and its slope per margin; one independent two-sided problem per column."""
    columns = margins.shape[1]
    wanted = np.array([1]) if columns == 1 else np.arange(columns)
    side = np.where(target[:, None] == wanted, 1.0, -1.0)
    slack = np.maximum(0.0, 1.0 - side * margins)
    return float((slack**2).sum()), -2.0 * side * slack


squared_hinge.curvature = 2.0


def logistic(margins: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray]:
    """Log loss and its slope: sigmoid for one column (class 1 against class 0), else softmax."""
    columns = margins.shape[1]
    scores = np.column_stack([np.zeros(len(margins)), margins]) if columns == 1 else margins
    shifted = scores - scores.max(axis=1, keepdims=True)
    chance = np.exp(shifted)
    total = chance.sum(axis=1)
    rows = np.arange(len(target))
    value = float((np.log(total) - shifted[rows, target]).sum())
    chance /= total[:, None]
    chance[rows, target] -= 1.0
    return value, chance[:, -columns:]


logistic.curvature = 0.25


@dataclass(frozen=True)
class Problem:
    """cost * summed loss + half the squared weights. With `kept`, only these positions have weights."""

    loss: Callable
    cost: float = 1.0
    penalise_intercept: bool = False
    kept: np.ndarray | None = None
    tolerance: float = 1e-4
    max_iterations: int = 2000


def place_type(size: int) -> np.dtype:
    """The smallest type of positions below `size`."""
    return np.min_scalar_type(max(size - 1, 0))


def pieces(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring rows of up to `most` entries together, or one row; `ends` are where each row's entries end."""
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, "right")))
        yield low, high
        low = high


def packed(rows: DataFrame, size: int, used: np.ndarray | None = None) -> DataFrame:
    """Blocks of rows (target, positions, weights): targets, where each row's entries end, positions, weights. Of `size`
    positions only those in `used` are kept, if it is given, and become places in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = None
        if used is not None:
            place = np.full(size, -1)
            place[used] = np.arange(len(used))
        kind = place_type(size if used is None else len(used))

        def block(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            columns[1] = np.cumsum(columns[1])
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in columns], names=["targets", "ends", "positions", "weights"])

        parts, entries = [], 0
        for batch in batches:
            lists = batch.column("positions")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = lists.flatten().to_numpy(zero_copy_only=False)
            values = batch.column("weights").flatten().to_numpy(zero_copy_only=False)
            target = batch.column("target").to_numpy(zero_copy_only=False).astype(np.int64)
            if place is not None:
                at = place[at]
                inside = at >= 0
                before, ends = np.concatenate([[0], np.cumsum(inside)]), np.cumsum(counts)
                at, values, counts = at[inside], values[inside], before[ends] - before[ends - counts]
            at, ends = at.astype(kind), np.cumsum(counts)
            for low, high in pieces(ends, BLOCK_ENTRIES):
                a, b = ends[low] - counts[low], ends[high - 1]
                parts.append([target[low:high], counts[low:high], at[a:b], values[a:b]])
                entries += b - a + high - low
                if entries >= BLOCK_ENTRIES:
                    yield block(parts)
                    parts, entries = [], 0
        if parts:
            yield block(parts)

    return rows.mapInArrow(run, BLOCK)


def blocks_of(batch: pa.RecordBatch, size: int) -> Iterator[list[np.ndarray]]:
    """Targets, ends, positions and weights of the blocks of a batch, some of them put together."""
    kinds = {"targets": np.int64, "ends": np.int64, "positions": place_type(size), "weights": float}
    parts, entries = [], 0
    for k in range(batch.num_rows):
        parts.append([np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in kinds.items()])
        entries += len(parts[-1][2])
        if entries >= PASS_ENTRIES or k == batch.num_rows - 1:
            before = np.cumsum([0, *(len(x[2]) for x in parts[:-1])])
            targets, ends, at, values = zip(*parts, strict=True)
            yield [np.concatenate(targets), np.concatenate([e + n for e, n in zip(ends, before, strict=True)]), np.concatenate(at).astype(np.intp), np.concatenate(values)]
            parts, entries = [], 0


def block_sums(columns: list[np.ndarray], asked: list[tuple[Callable, np.ndarray, np.ndarray | None]], size: int) -> list[np.ndarray]:
    """Gradient (columns x (positions + 1), flat) and value of each asked (loss, weights, kept) over one block."""
    target, ends, at, values = columns
    starts = np.concatenate([[0], ends[:-1]])
    counts = ends - starts
    full = np.flatnonzero(counts)
    out = []
    for loss, weights, kept in asked:
        margins = np.tile(weights[:, -1], (len(target), 1))
        for c, w in enumerate(weights):
            whole = w[:-1]
            if kept is not None:
                whole = np.zeros(size)
                whole[kept] = w[:-1]
            if len(full):
                margins[full, c] += np.add.reduceat(values * whole[at], starts[full])
        value, slope = loss(margins, target)
        gradient = np.empty(weights.shape)
        for c in range(len(weights)):
            sums = np.bincount(at, weights=values * np.repeat(slope[:, c], counts), minlength=size)
            gradient[c, :-1] = sums if kept is None else sums[kept]
        gradient[:, -1] = slope.sum(axis=0)
        out.append(np.append(gradient.ravel(), value))
    return out


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in batch.column("sums"):
            part = np.frombuffer(x.as_buffer())
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def added_up(sums: DataFrame, parts: int) -> DataFrame:
    """One row with the sum of the arrays of `parts` partitions; none if these have none."""
    if parts > DIRECT_PARTS:
        sums = sums.repartition(int(np.ceil(np.sqrt(parts)))).mapInArrow(_added, "sums binary")
    return sums.repartition(1).mapInArrow(_added, "sums binary") if parts > 1 else sums


def summed(blocks: DataFrame, asked: list[tuple[Callable, np.ndarray, np.ndarray | None]], size: int, parts: int) -> list[np.ndarray]:
    """`block_sums` over all blocks, in one pass."""
    shared = blocks.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for columns in blocks_of(batch, size):
                part = np.concatenate(block_sums(columns, shared.value, size))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    rows = [np.frombuffer(r["sums"]) for r in added_up(blocks.mapInArrow(run, "sums binary"), parts).collect()]
    shared.unpersist()
    sizes = [weights.size + 1 for _, weights, _ in asked]
    total = np.sum(rows, axis=0) if rows else np.zeros(sum(sizes))
    return np.split(total, np.cumsum(sizes)[:-1])


def squared_sums(blocks: DataFrame, size: int) -> np.ndarray:
    """Summed squared weight of each position over all blocks, and at the end the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1)
        for batch in batches:
            for targets, _, at, values in blocks_of(batch, size):
                total[:-1] += np.bincount(at, weights=values * values, minlength=size)
                total[-1] += len(targets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    return sum((np.frombuffer(r["sums"]) for r in blocks.mapInArrow(run, "sums binary").collect()), np.zeros(size + 1))


Steps = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


def steps(start: np.ndarray, tolerance: float, max_iterations: int, memory: int = MEMORY, scale: np.ndarray | float = 1.0) -> Steps:
    """L-BFGS with step halving, over the point divided by `scale`. Yields the points whose value and gradient it wants,
    returns the last one. The tolerance is that of the gradient as it is."""
    x = start
    value, gradient = yield x
    first = np.linalg.norm(gradient)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(max_iterations):
        if np.linalg.norm(gradient) <= tolerance * max(first, 1e-12):
            break
        direction = -scale * _inverse_hessian_times(pairs, scale * gradient)
        slope = gradient @ direction
        step = 1.0 if pairs else min(1.0, 1.0 / np.linalg.norm(scale * gradient))
        for _ in range(40):
            moved = x + step * direction
            new_value, new_gradient = yield moved
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        change = ((moved - x) / scale, (new_gradient - gradient) * scale)
        if change[0] @ change[1] > 1e-12:
            pairs = [*pairs, change][-memory:]
        x, value, gradient = moved, new_value, new_gradient
    return x


def minimise(evaluate_all: Callable[[dict[int, np.ndarray]], dict[int, tuple[float, np.ndarray]]], searches: list[Steps]) -> list[np.ndarray]:
    """Run searches side by side: one evaluation serves the wanted points of all that still move."""
    found: dict[int, np.ndarray] = {}
    wanted = {i: next(search) for i, search in enumerate(searches)}
    while wanted:
        answers = evaluate_all(wanted)
        for i, answer in answers.items():
            try:
                wanted[i] = searches[i].send(answer)
            except StopIteration as end:
                found[i] = end.value
                del wanted[i]
    return [found[i] for i in range(len(searches))]


def _inverse_hessian_times(pairs, gradient: np.ndarray) -> np.ndarray:
    q = gradient.copy()
    steps = []
    for s, y in reversed(pairs):
        a = (s @ q) / (s @ y)
        q -= a * y
        steps.append(a)
    if pairs:
        s, y = pairs[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(pairs, reversed(steps)):
        q += (a - (y @ q) / (s @ y)) * s
    return q


def fit_linear(
    train: DataFrame, classes: list[str], size: int, problems: list[Problem], features: str = "features", label: str = "label"
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(coefficients, intercepts) of each problem: one row for two classes, else one row per class. Coefficients of
    positions that a problem does not keep are 0."""
    columns = 1 if len(classes) == 2 else len(classes)
    raw = F.unwrap_udt(features)
    names = F.array(*[F.lit(c) for c in classes])
    rows = train.select(
        (F.array_position(names, F.col(label)).cast("int") - 1).alias("target"),
        raw["indices"].alias("positions"),
        raw["values"].alias("weights"),
    )
    # What no problem keeps is not packed; from here on positions are places in `used`.
    used = None if any(p.kept is None for p in problems) else np.unique(np.concatenate([p.kept for p in problems]))
    width = size if used is None else len(used)
    masks = [None if p.kept is None or np.array_equal(p.kept, used) else p.kept if used is None else np.searchsorted(used, p.kept) for p in problems]
    cores = max(1, train.sparkSession.sparkContext.defaultParallelism)
    blocks = packed(rows.coalesce(cores), size, used).persist(StorageLevel.DISK_ONLY)
    parts = blocks.select(F.spark_partition_id().alias("part")).distinct().count()
    widths = [size if p.kept is None else len(p.kept) for p in problems]

    def evaluate_all(wanted: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        asked = [(problems[i].loss, x.reshape(columns, -1), masks[i]) for i, x in wanted.items()]
        answers = {}
        for (i, x), sums in zip(wanted.items(), summed(blocks, asked, width, parts), strict=True):
            penalised = x.reshape(columns, -1).copy()
            if not problems[i].penalise_intercept:
                penalised[:, -1] = 0.0
            penalised = penalised.ravel()
            answers[i] = (problems[i].cost * sums[-1] + 0.5 * penalised @ penalised, problems[i].cost * sums[:-1] + penalised)
        return answers

    def scale(problem: Problem, mask: np.ndarray | None) -> np.ndarray:
        """One over the root of the curvature that a weight can expect; the penalty adds 1 to it."""
        own = squares if mask is None else np.append(squares[:-1][mask], squares[-1])
        expected = CURVED * problem.loss.curvature * problem.cost * own
        expected[:-1] += 1.0
        expected[-1] += float(problem.penalise_intercept)
        return np.tile(1.0 / np.sqrt(np.maximum(expected, 1e-12)), columns)

    try:
        squares = squared_sums(blocks, width)
        searches = [steps(np.zeros(columns * (w + 1)), p.tolerance, p.max_iterations, scale=scale(p, m)) for p, w, m in zip(problems, widths, masks, strict=True)]
        out = []
        for p, x in zip(problems, minimise(evaluate_all, searches), strict=True):
            x = x.reshape(columns, -1)
            coefficients = x[:, :-1]
            if p.kept is not None:
                coefficients = np.zeros((columns, size))
                coefficients[:, p.kept] = x[:, :-1]
            out.append((coefficients, x[:, -1]))
        return out
    finally:
        blocks.unpersist()
