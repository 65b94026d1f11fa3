"""Plain Python counterparts to compare with."""

import math
from collections import Counter


def terms(text, stops=(), bigrams=False):
    words = [w for w in text.split() if len(w) >= 2 and w not in stops]
    return words + ([f"{a} {b}" for a, b in zip(words, words[1:])] if bigrams else [])


def vocabulary(texts, stops=(), bigrams=False, min_df=1, max_df=1.0, max_features=10**6):
    counts = [Counter(terms(t, stops, bigrams)) for t in texts]
    df, ctf = Counter(), Counter()
    for c in counts:
        df.update(c.keys())
        ctf.update(c)
    kept = [t for t in df if min_df <= df[t] <= max_df * len(texts)]
    kept = sorted(sorted(kept, key=lambda t: (-ctf[t], t))[:max_features])
    return {t: (df[t], ctf[t], math.log((1 + len(texts)) / (1 + df[t])) + 1) for t in kept}


def weights(text, vocab, stops=(), bigrams=False):
    raw = {t: n * vocab[t][2] for t, n in Counter(terms(text, stops, bigrams)).items() if t in vocab}
    norm = math.sqrt(sum(w * w for w in raw.values())) or 1.0
    return {t: w / norm for t, w in raw.items()}


def dot(a, b):
    return sum(w * b.get(t, 0.0) for t, w in a.items())
