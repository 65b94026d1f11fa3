"""Plain versions of the operators' contracts, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def line_dedup(rows, least=10):
    found = defaultdict(set)
    split = [(d, (t or "").split("\n")) for d, t in rows]

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    for d, lines in split:
        for x in lines:
            if key(x):
                found[key(x)].add(d)
    out = []
    for d, lines in split:
        kept = [x for x in lines if len(found.get(key(x), ())) < least]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def repeats(words, least):
    """Positions in windows of `least` words that occur twice."""
    count = Counter(tuple(words[i : i + least]) for i in range(len(words) - least + 1))
    hit = set()
    for i in range(len(words) - least + 1):
        if count[tuple(words[i : i + least])] > 1:
            hit.update(range(i, i + least))
    return hit


def said_again(words, least):
    """Positions in windows of `least` words that came before."""
    seen, hit = set(), set()
    for i in range(len(words) - least + 1):
        w = tuple(words[i : i + least])
        if w in seen:
            hit.update(range(i, i + least))
        seen.add(w)
    return hit


def longest_repeat(words):
    low, high = 0, max(0, len(words) - 1)  # a prefix of a repeat is a repeat
    while low < high:
        k = (low + high + 1) // 2
        low, high = (k, high) if repeats(words, k) else (low, k - 1)
    return low


def quality(text, least=8, max_repeated=0.15, max_longest=100):
    text = text or ""
    words = WORD.findall(text)
    n, repeated, covered = len(words), len(repeats(words, 3)), len(repeats(words, least))
    again, longest = len(said_again(words, least)), longest_repeat(words)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = n < 50 or 100 * repeated > 50 * n
    kept = not failed and again <= max_repeated * n and longest <= max_longest
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, repeated, covered, again, longest, failed, kept


def earlier_substrings(rows, size=50):
    first = {}
    order = {d: (d is None, d) for d, _ in rows}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - size + 1):
            w = b[i : i + size]
            first[w] = min(first.get(w, order[d]), order[d], key=lambda x: (x[0], x[1] or 0))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            a = first[b[i : i + size]]
            if (a[0], a[1] or 0) < (order[d][0], order[d][1] or 0):
                gone[i : i + size] = [True] * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, sha(kept)))
    return sorted(out, key=repr)


def repeated_passages(rows, size=35):
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    count = Counter(tuple(w[i : i + size]) for _, w in split for i in range(len(w) - size + 1))
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=repr)


def shingles(text, size):
    words = [w for w in WORD.findall((text or "").translate(LOWER))]
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_duplicates(rows, size=3, percent=85):
    sets = [shingles(t, size) for _, t in rows]
    boss = list(range(len(rows)))

    def top(i):
        while boss[i] != i:
            i = boss[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                boss[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(sets[i]), least.get(top(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def contamination(rows, items, size=13):
    held = defaultdict(set)
    for item, text in items:
        words = PLAIN.findall((text or "").translate(LOWER))
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            held[tuple(words[i : i + n])].add("" if item is None else str(item))
    out = []
    for d, t in rows:
        words = PLAIN.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in held}:
            for i in range(len(words) - n + 1):
                ids = held.get(tuple(words[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        out.append((d, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def shards(rows, count=24):
    """Contiguous shards in order of id and checksum."""
    sized = sorted((d is not None, d or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for d, t in rows)
    total, before, out, slots = sum(x[3] for x in sized), 0, [], Counter()
    for there, d, crc, size in sized:
        shard = min(count - 1, (2 * before + size) * count // (2 * total))
        out.append((d if there else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return sorted(out, key=repr)


def spelling(rows, least_letters=6, least_count=5, factor=5, every=199):
    """Words, their forms and roots, by all deletions of all words."""
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= least_letters and n >= least_count}
    near, cuts = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1 :]
            cuts[cut, i].add(w)
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    for group in cuts.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=repr)


def rebuilt(rows, block=20, most=3):
    """conv_id -> (role, text) turns after the first ones are borrowed."""
    turns = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((n is not None, n or 0, sha(f"{len(role)}:{role}{text}"), (role, text)))
    turns = {c: [x[-1] for x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        out[c] = tuple(turns.get(c - int(math.fmod(c, block)), [])[:h] + own[h:])
    return out


def prefix_trie(rows):
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, path in sorted(rebuilt(rows).items()):
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            below[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[x] for x in below[path]) or 1
        own = (len(members[path]) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        saved[path] = own + sum(saved[x] for x in below[path])
    return sorted(
        (
            (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(below[p]), leaves[p], saved[p], sha(",".join(map(str, ends[p]))))
            for p, m in members.items()
        ),
        key=repr,
    )
