"""Operators written out over lists in plain Python, for small tables."""

import hashlib
import math
import re

import numpy as np
import pyarrow as pa

from placefolio.llm import mixing, quality

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ftrl_scores(texts, train):
    """Score of each text by the updates as published, one coordinate at a time. ``train`` has ``(text, label)`` in order."""
    z, n = {}, {}

    def features(text):
        (index, value), = quality.features(pa.array([text], pa.string()))
        return list(zip(index.tolist(), value.astype(float).tolist()))

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * quality.L1) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    def chance(found):
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(weight(i) * v for i, v in found)))))

    for text, label in train:
        found = features(text)
        p = chance(found)
        # All of a text's coordinates move from where they were; of entries with one index the last one counts.
        moved = {}
        for i, v in found:
            g = (p - label) * v
            s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality.ALPHA
            moved[i] = (z.get(i, 0.0) + g - s * weight(i), n.get(i, 0.0) + g * g)
        for i, (a, b) in moved.items():
            z[i], n[i] = a, b
    return [chance(features(t)) for t in texts]


def first_of_equal(rows):
    """Ids that stay when of texts that are equal up to blanks the smallest id stays."""
    first = {}
    for i, t in sorted(rows.items()):
        first.setdefault(re.sub("[\x20\x09-\x0D]+", " ", t or ""), i)
    return set(first.values())


def first_of_near(rows, percent):
    """The same for components of documents whose sets of five-word shingles are alike."""
    sets = {}
    for i, t in rows.items():
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in rows}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(rows)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {i for i in rows if root(i) == i}


def repetitions(rows):
    """``doc_id -> times taken`` from ``doc_id -> (source, text)``: targets by water-filling, then the seeded order."""
    size = {i: len(words(t)) for i, (_, t) in rows.items()}
    sources = sorted({s for s, _ in rows.values()}, key=lambda s: (s is None, s or ""))
    total_of = {s: sum(size[i] for i, (other, _) in rows.items() if other == s) for s in sources}
    weight = {s: mixing.WEIGHTS[k % len(mixing.WEIGHTS)] for k, s in enumerate(sources)}
    full, left = set(), sum(total_of.values())
    while True:
        open_ = [s for s in sources if s not in full]
        rest = left - sum(mixing.MAX_EPOCHS * total_of[s] for s in full)
        target = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if target[s] >= mixing.MAX_EPOCHS * total_of[s]]
        if not above:
            break
        full |= set(above)
        if len(full) == len(sources):
            break
    target = {s: float(mixing.MAX_EPOCHS * total_of[s]) if s in full else target[s] for s in sources}
    taken = {}
    for s in sources:
        turn = lambda i: int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:mixing.ORDER_HEX], 16)
        whole = min(int(target[s] // total_of[s]) if total_of[s] else 0, mixing.MAX_EPOCHS)
        need, before = target[s] - whole * total_of[s], 0
        for i in sorted((i for i, (other, _) in rows.items() if other == s), key=lambda i: (turn(i), i)):
            extra = need > 0 and before + size[i] / 2 <= need
            taken[i] = min(whole + extra, mixing.MAX_EPOCHS)
            before += size[i]
    return taken


def sorted_values(text, width):
    """Values of a text's n-grams of words as the features should have them, from largest to smallest, before the bias."""
    w = words(text)
    grams = [tuple(w[i:i + k]) for k in range(1, width + 1) for i in range(len(w) - k + 1)]
    return sorted((math.log1p(grams.count(g)) for g in set(grams)), reverse=True), np.float32
