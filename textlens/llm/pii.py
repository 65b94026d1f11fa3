"""Personal data: fixed base patterns, and a semi-Markov conditional random field that adds spans."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret")
#: Tokens around one that holds a digit or @; tokens of a segment at most; weights of each kind.
AROUND, LONGEST, WEIGHTS = 3, 6, 1 << 12
#: Characters of a training text, and of a segment that the field may add (a longer one is no candidate).
EXCERPT, SEGMENT = 20_000, 120
HOT = re.compile("[0-9@]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CHUNK = re.compile(r"[^ \t-\r]+")
#: Weak labels for keys, which have no base pattern.
SECRET = re.compile(r"(?i)\b(?:token|secret|key|password)\s*[=:]\s*[\"']?([0-9a-f]{24,})\b")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by kind and start. Each kind's are leftmost and don't overlap.

    Time is linear in the text: an address is looked up from its @ backwards, and dotted numbers are cut in fours from
    whole chains.
    """
    spans: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            end = found.end()
            spans.append(("email", start, end))
        at = text.find("@", at + 1)
    for chain in DOTTED.finditer(text):
        parts = list(re.finditer("[0-9]+", chain.group()))
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(p.group().lstrip("0")) <= 3 and int(p.group()[-3:]) <= 255 for p in four):
                spans.append(("ip", chain.start() + four[0].start(), chain.start() + four[-1].end()))
    for kind, pattern, low, high in (("card", CARD, 13, 19), ("phone", PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                spans.append((kind, m.start(), m.end()))
    return spans


def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of tokens near a digit or @: a token is a string between white space without the signs around it."""
    tokens, hot = [], []
    for m in CHUNK.finditer(text):
        chunk = m.group()
        core = chunk.lstrip("\"'<[{=:;,") or chunk
        start = m.start() + len(chunk) - len(core)
        core = core.rstrip("\"'.,;:!?>]}#$%&*|=") or core[:1]
        if core.endswith(")") and "(" not in core:
            core = core.rstrip(")") or core
        tokens.append((start, start + len(core)))
        hot.append(bool(HOT.search(core)))
    at = np.flatnonzero(hot)
    if not len(at):
        return
    for group in np.split(at, np.flatnonzero(np.diff(at) > 2 * AROUND) + 1):
        yield tokens[max(0, group[0] - AROUND) : group[-1] + AROUND + 1]


def _bucket(n: int, bounds: tuple[int, ...]) -> int:
    return sum(n >= b for b in bounds)


@lru_cache(maxsize=20_000)
def features(span: str, tokens: int, before: str, after: str) -> tuple[int, ...]:
    """Numbers of the features of a whole candidate span with its neighbours."""
    digits = re.sub("[^0-9]", "", span)
    n, letters = len(digits), re.sub("[^A-Za-z]", "", span)
    shape = re.sub("9+", "9", re.sub("[0-9]", "9", re.sub(r"[^\W\d_]+", "a", span)))
    hexed = bool(re.fullmatch("[0-9a-fA-F]+", span))
    parts = span.split(".")
    names = [
        f"digits {_bucket(n, (1, 4, 9, 13, 16, 20))}",
        f"tokens {tokens}",
        f"at {min(span.count('@'), 2)} dots {min(span.count('.'), 4)}",
        f"first {span[0] if not span[0].isalnum() else 'd' if span[0].isdigit() else 'a'}",
        f"last {span[-1] if not span[-1].isalnum() else 'd' if span[-1].isdigit() else 'a'}",
        f"letters {0 if not letters else 1 if hexed else 2} length {_bucket(len(span), (4, 8, 12, 16, 24, 40))}",
        f"luhn {13 <= n <= 19 and not letters and luhn(digits)}",
        f"parts {len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}",
        f"before {before[-1:] if before and not before[-1].isalnum() else before.lower()}",
        f"after {after[:1] if after and not after[0].isalnum() else ''}",
        f"shape {shape[:40]}",
        f"gap digits {_bucket(n, (1, 9, 16))} brackets {'(' in span} plus {span[0] == '+'}",
        f"hex {hexed} digits {_bucket(n, (1, 9, 16))} length {_bucket(len(span), (16, 24, 40))}",
        "bias",
    ]
    return tuple(zlib.crc32(x.encode()) % WEIGHTS for x in names)


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, tuple[int, ...]]]:
    """(first token, end token, features) of all segments with a digit or @, of at most LONGEST tokens and SEGMENT characters."""
    out = []
    for i in range(len(tokens)):
        for j in range(i + 1, min(len(tokens), i + LONGEST) + 1):
            span = text[tokens[i][0] : tokens[j - 1][1]]
            if len(span) > SEGMENT:
                break
            if HOT.search(text, tokens[i][0], tokens[i][1]) or span[0] in "+(":
                if HOT.search(text, tokens[j - 1][0], tokens[j - 1][1]):
                    before = text[tokens[i - 1][0] : tokens[i][0]].strip()[-12:] if i else ""
                    after = text[tokens[j - 1][1] : tokens[j - 1][1] + 1].strip()
                    out.append((i, j, features(span, j - i, before, after)))
    return out


def decode(weights: np.ndarray, count: int, found: list[tuple[int, int, tuple[int, ...]]], margin: float = 0.0) -> list[tuple[int, int, int]]:
    """The best cover of a window's tokens by segments: (first, end, kind); tokens outside score 0."""
    best, back = [0.0] * (count + 1), [None] * (count + 1)
    by_end: dict[int, list] = {}
    for i, j, f in found:
        scores = weights[list(f)].sum(axis=0)
        k = int(scores.argmax())
        by_end.setdefault(j, []).append((i, k, float(scores[k]) - margin))
    for j in range(1, count + 1):
        best[j] = best[j - 1]
        for i, k, s in by_end.get(j, ()):
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, k)
    out, j = [], count
    while j > 0:
        if back[j]:
            i, k = back[j]
            out.append((i, j, k))
            j = i
        else:
            j -= 1
    return out[::-1]


def fit(examples: list[tuple[int, list[tuple[int, int, tuple[int, ...]]], dict[tuple[int, int], int]]], epochs: int = 4, rate: float = 0.3) -> np.ndarray:
    """Weights that maximise the likelihood of the labelled segmentations, by AdaGrad over windows.

    The sum over all segmentations runs forwards and backwards over tokens; a segment's probability times its features
    is what the gradient expects.
    """
    weights, seen = np.zeros((WEIGHTS, len(KINDS))), np.full((WEIGHTS, len(KINDS)), 1e-6)
    for _ in range(epochs):
        for count, found, gold in examples:
            if not found:
                continue
            index = np.array([f for _, _, f in found])
            scores = weights[index].sum(axis=1)
            whole = np.logaddexp.reduce(scores, axis=1)
            forward, backward = np.zeros(count + 1), np.zeros(count + 1)
            ending: dict[int, list[int]] = {}
            starting: dict[int, list[int]] = {}
            for n, (i, j, _) in enumerate(found):
                ending.setdefault(j, []).append(n)
                starting.setdefault(i, []).append(n)
            for j in range(1, count + 1):
                forward[j] = np.logaddexp.reduce([forward[j - 1], *(forward[found[n][0]] + whole[n] for n in ending.get(j, ()))])
            for i in range(count - 1, -1, -1):
                backward[i] = np.logaddexp.reduce([backward[i + 1], *(backward[found[n][1]] + whole[n] for n in starting.get(i, ()))])
            change = np.zeros_like(scores)
            for n, (i, j, _) in enumerate(found):
                change[n] = -np.exp(forward[i] + scores[n] + backward[j] - forward[count])
                if (i, j) in gold:
                    change[n, gold[i, j]] += 1
            for n in np.flatnonzero(np.abs(change).max(axis=1) > 1e-3):
                at = index[n]
                g = change[n] - 1e-4 * weights[at]
                seen[at] += g * g
                weights[at] += rate * g / np.sqrt(seen[at])
    return weights


def labelled_windows(text: str) -> Iterator[tuple[int, list, dict[tuple[int, int], int]]]:
    """Training windows of a text: base spans and key patterns as labels; windows in which a label cuts a token are left
    out. Phones also come without their plus, so that the model learns more than the patterns."""
    pluses = {s for k, s, _ in base_spans(text) if k == "phone"}
    versions = [(text, base_spans(text))]
    if pluses:
        gone = np.cumsum([0, *(i in pluses for i in range(len(text)))])
        bare = "".join(c for i, c in enumerate(text) if i not in pluses)
        versions.append((bare, [(k, s - int(gone[s]), e - int(gone[e])) for k, s, e in versions[0][1]]))
    for version, spans in versions:
        spans = spans + [("secret", m.start(1), m.end(1)) for m in SECRET.finditer(version)]
        for tokens in windows(version):
            first, last = {s: i for i, (s, _) in enumerate(tokens)}, {e: i + 1 for i, (_, e) in enumerate(tokens)}
            inside = [(k, s, e) for k, s, e in spans if tokens[0][0] <= s < tokens[-1][1]]
            if all(s in first and e in last for _, s, e in inside):
                gold = {(first[s], last[e]): KINDS.index(k) for k, s, e in inside if last[e] - first[s] <= LONGEST}
                yield len(tokens), candidates(version, tokens), gold


def _excerpts(text: Column) -> Column:
    """The texts to train on: a text itself, or a long one in excerpts of up to EXCERPT characters, without the strings
    that their edges cut."""
    size = F.length(text)
    last = F.floor((size - 1) / EXCERPT)

    def excerpt(i: Column) -> Column:
        part = F.substring(text, i * EXCERPT + 1, F.lit(EXCERPT))
        part = F.when(i > 0, F.regexp_replace(part, "^[^ \\t-\\r]+", "")).otherwise(part)
        return F.when(i < last, F.regexp_replace(part, "[^ \\t-\\r]+$", "")).otherwise(part)

    return F.when(size <= EXCERPT, F.array(text)).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), last), excerpt))


def train(docs: DataFrame, sample: int = 400) -> np.ndarray:
    """Fit the field on the `sample` texts with digits or @ that have the least hash: a bounded, fixed draw, in which texts
    of over EXCERPT characters take part by their excerpts. Without such texts, no weight is set and no span is added."""
    cut = docs.filter(F.col("text").rlike("[0-9@]")).select(F.explode(_excerpts(F.col("text"))).alias("text"))
    rows = cut.filter(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("_h")).distinct().orderBy("_h", "text").limit(sample)
    examples = [x for r in rows.collect() for x in labelled_windows(r["text"])]
    return fit(examples)


def all_spans(text: str | None, weights: np.ndarray, margin: float) -> tuple[list[Span], list[Span]]:
    """Base spans, and those that the field adds: they overlap no base span."""
    if not text or not HOT.search(text):
        return [], []
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    begins = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0)
    added = []
    for tokens in windows(text):
        for i, j, k in decode(weights, len(tokens), candidates(text, tokens), margin):
            s, e = tokens[i][0], tokens[j - 1][1]
            n = np.searchsorted(begins, e, side="left")
            if not n or reach[n - 1] <= s:
                added.append((KINDS[k], s, e))
    return base, added


def personal_data(docs: DataFrame, text: Column, margin: float = 4.0, sample: int = 400) -> Column:
    """A struct of `base` and `added`: arrays of (kind, start, end) in code points, end exclusive.

    Base spans are those of the fixed patterns. The field scores whole candidate spans of up to 6 tokens and 120
    characters (a longer key or token is never added) near digits or @ and chooses boundaries and kinds of a window together; a span is added if it beats no span by `margin`. It is
    trained on `sample` texts of `docs`. Null and empty texts have no spans; texts are read whole.
    """
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, sample))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            hot = pc.fill_null(pc.match_substring_regex(pa.array(series, pa.string(), from_pandas=True), "[0-9@]"), False).to_numpy(zero_copy_only=False)
            found = [all_spans(t, weights.value, margin) if h else ([], []) for t, h in zip(series, hot, strict=True)]
            yield pd.DataFrame({name: [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x[k]] for x in found] for k, name in enumerate(("base", "added"))})

    spans = "array<struct<kind: string, start: int, end: int>>"
    return F.pandas_udf(run, f"base {spans}, added {spans}")(text)


def listed(spans: Column) -> Column:
    """kind:start:end of spans, by kind as listed and start, joined by commas."""
    rank = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    keyed = F.transform(spans, lambda s: F.struct(rank[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
