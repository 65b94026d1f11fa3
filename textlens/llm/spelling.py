"""Groups of spelling variants: pivotal grams find the words one edit apart, forms lead to each group's root."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.shared import lowered, partitions_for, stored

RUN = r"([A-Za-zÀ-ÿ]+)"
#: Letters of a gram. One edit spoils two grams at most, so that of the three rarest two are disjoint.
GRAM = 2
#: Words of a task that builds keys.
WORDS_IN_TASK = 50_000


def damaged(run: Column, doc_id: Column, every: int) -> Column:
    """The run; without its code point h % length if `every` divides h, the crc32 of `<doc_id>:<run>`. A null doc_id
    counts as an empty one."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def word_counts(docs: DataFrame, least_letters: int, least_count: int, every: int | None = None) -> DataFrame:
    """(word, n): runs of letters of whole texts, A-Z in lower case, with their occurrences. Null texts have none."""
    # A deletion only shortens, so runs below the least length go first.
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lowered(F.col("text")), F.lit(RUN), F.lit(1))).alias("run")).filter(F.length("run") >= least_letters)
    word = F.col("run") if every is None else damaged(F.col("run"), F.col("doc_id"), every)
    counted = runs.select(word.alias("word")).filter(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def gram_ranks(words: DataFrame) -> dict[str, tuple[int, str]]:
    """Place of each gram in the common order, rare ones first: (number of places in all words, gram). There are at most
    as many grams as pairs of letters, 8,100 for the runs above, so this is a bounded table."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - (GRAM - 1)), lambda i: F.substring("word", i, F.lit(GRAM)))).alias("gram"))
    return {r["gram"]: (r["n"], r["gram"]) for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}


def prefix_and_pivots(word: str, ranks: dict[str, tuple[int, str]]) -> tuple[list[int], list[int]]:
    """Places of the prefix and of the pivotal grams of a word of at least four letters.

    The three first grams in the common order, of equal grams the leftmost, hold the pivots: the two disjoint ones with
    the least number of occurrences. They are found from left to right, by the best single gram that ends before the next
    begins and the best pair so far. The prefix has all grams before the third in the common order, and the first five
    places of the third: it is a pivot at its third place at most, and an edit makes two more places at most.
    """
    order = sorted(range(len(word) - GRAM + 1), key=lambda i: (ranks[word[i : i + GRAM]], i))
    last = ranks[word[order[GRAM] : order[GRAM] + GRAM]]
    prefix = [i for i in order if ranks[word[i : i + GRAM]] < last]
    prefix += [i for i in order[len(prefix) : len(prefix) + 2 * GRAM + 1] if ranks[word[i : i + GRAM]] == last]
    rare = sorted(order[: GRAM + 1])
    pair: tuple[int, int, int] | None = None
    single: tuple[int, int] | None = None
    ended = 0  # rare places that `single` covers
    for i in rare:
        cost = ranks[word[i : i + GRAM]][0]
        while rare[ended] + GRAM <= i:
            one = (ranks[word[rare[ended] : rare[ended] + GRAM]][0], rare[ended])
            single = one if single is None else min(single, one)
            ended += 1
        if single is not None and (pair is None or single[0] + cost < pair[0]):
            pair = (single[0] + cost, single[1], i)
    return prefix, [pair[1], pair[2]]


def _pivot_keys(word: str, i: int) -> list[str]:
    """What a word one edit away has in common, if the gram at i is left as it is: all on one side of the gram, at the
    same place from that end, and half of the other side, at the same place from its near or its far end."""
    n, rest, before = len(word), len(word) - i - GRAM, i
    right, left = rest // 2, before // 2
    return [
        f"a{i},{right}:{word[: i + GRAM + right]}",  # edit far to the right
        f"b{i},{rest - right}:{word[: i + GRAM]}:{word[n - (rest - right) :]}",  # near on the right
        f"c{rest},{left}:{word[i - left :]}",  # far to the left
        f"d{rest},{before - left}:{word[i:]}:{word[: before - left]}",  # near on the left
    ]


def _prefix_keys(word: str, i: int) -> set[str]:
    """The keys under which words one edit away may have this gram as a pivot: their other side is up to a letter
    shorter or longer, and so are its halves."""
    n, rest, before = len(word), len(word) - i - GRAM, i
    out = set()
    for other in (rest - 1, rest, rest + 1):
        near, far = other // 2, other - other // 2
        if 0 <= other and near <= rest:
            out.add(f"a{i},{near}:{word[: i + GRAM + near]}")
        if 0 <= other and far <= rest:
            out.add(f"b{i},{far}:{word[: i + GRAM]}:{word[n - far :]}")
    for other in (before - 1, before, before + 1):
        near, far = other // 2, other - other // 2
        if 0 <= other and near <= before:
            out.add(f"c{rest},{near}:{word[i - near :]}")
        if 0 <= other and far <= before:
            out.add(f"d{rest},{far}:{word[i:]}:{word[:far]}")
    return out


def _keys(batches: Iterator[pa.RecordBatch], ranks: dict[str, tuple[int, str]], pivots: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, counts, keys, owner = batch.column("word").to_pylist(), batch.column("n"), [], []
        for w, word in enumerate(words):
            prefix, chosen = prefix_and_pivots(word, ranks)
            own = {k for i in (chosen if pivots else prefix) for k in (_pivot_keys if pivots else _prefix_keys)(word, i)}
            keys.extend(xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in own)
            owner.extend([w] * len(own))
        at = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column("word").take(at), counts.take(at)], names=["key", "word", "n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): each pair of different words one inserted, deleted or replaced code point apart, in both
    directions. `words` (word, n) has distinct words of four or more letters; shorter ones raise an error in the task.

    Of two such words, take as r the one whose prefix ends first in the common order. An edit spoils one of r's two
    disjoint pivots at most; the other one is a gram of the other word, and as it comes no later than the end of that
    word's prefix, it lies in the prefix. So pivots are joined with prefixes. Position limit: an edit on the right of
    the gram leaves its place from the left, and one on the left its place from the right; all on the other side is then
    equal, and the edit spares one half of its own side. All that is in the joined key, so that few pairs are left to
    verify. A hot gram alone is never a key.

    The join is a shuffle: Spark takes a table of keys to be as large as the words it comes from, which is dozens of
    times too low, and would broadcast it.
    """
    spark = words.sparkSession
    words = stored(words)
    words = words.repartition(partitions_for(words.count(), WORDS_IN_TASK, spark.sparkContext.defaultParallelism))
    ranks = spark.sparkContext.broadcast(gram_ranks(words))

    def keys(batches: Iterator[pa.RecordBatch], pivots: bool) -> Iterator[pa.RecordBatch]:
        return _keys(batches, ranks.value, pivots)

    index, probes = (words.mapInArrow(partial(keys, pivots=p), "key long, word string, n long") for p in (False, True))
    index = index.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    apart = (F.col("word") != F.col("near")) & (F.abs(F.length("word") - F.length("near")) <= 1)
    found = probes.join(index.hint("merge"), "key").filter(apart & (F.levenshtein("word", "near", 1) == 1)).select("word", "n", "near", "near_n")
    return found.union(found.select("near", "near_n", "word", "n")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to. Each round doubles the steps that a word has
    gone, so their number is the logarithm of the longest way. Forms must not lead in a circle. Joined by shuffles: the
    size of a stored table is that of its compressed file, in memory a broadcast takes many times that."""
    now = stored(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = stored(now.join(further.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        now = gone.select("word", "root")
        if gone.filter("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, least_letters: int = 6, least_count: int = 5, factor: int = 5, every: int | None = None) -> DataFrame:
    """A row for each word: word, n, n_near, form, form_n, root.

    Words are runs of letters of whole texts (doc_id, text), A-Z in lower case, of at least `least_letters` (4 or more)
    code points and `least_count` occurrences; with `every`, one run in so many loses a letter first (see `damaged`). form
    is the near word (one edit away) of largest n, of equal ones the first in code-point order, if it is `factor` times
    as frequent as the word, else null; root is the last word that forms lead to. Null and empty texts have no words;
    repeated rows count each time; an empty table gives an empty result. Only words and counts leave the texts.
    """
    if least_letters < 2 * GRAM or factor < 2:
        raise ValueError(f"least_letters {least_letters} is below {2 * GRAM} or factor {factor} below 2")
    words = stored(word_counts(docs, least_letters, least_count, every))
    # The least of (-n, word): UTF-8 bytes have the order of code points.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    near = near.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    joined = words.join(near.hint("merge"), "word", "left")
    frequent = F.col("near_n") >= factor * F.col("n")
    formed = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("near")).alias("form"), F.when(frequent, F.col("near_n")).alias("form_n")))
    return formed.join(roots(formed).hint("merge"), "word").select("word", "form", "root", "n", "n_near", "form_n")
