"""Plain Python versions of the operators' contracts, and small awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text, k):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def components(rows, k, num, den):
    """{doc_id: smallest linked id} of (doc_id, text) rows."""
    sets = [(d, shingles(t, k)) for d, t in rows]
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if s and t and den * both >= num * (len(s) + len(t) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d, _ in rows}


def repeats(texts, length):
    """(spans, kept bytes) of each text: what is left without the bytes under repeated strings."""
    raw = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for r in raw:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] += 1
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = [(m.start(), m.end() - m.start()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((spans, bytes(b for b, g in zip(r, gone, strict=True) if not g)))
    return out


def contamination(docs, items, window=10):
    wanted = defaultdict(set)
    for item, text in items:
        w = letters(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wanted[tuple(w[i : i + n])].add(str(item) if item is not None else "")
    sizes = {len(p) for p in wanted}
    out = []
    for doc, text in docs:
        w, hit, found = letters(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (got := wanted.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= got
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def near_copies(seed=5, n=60):
    """Rows (doc_id, text) with exact copies, near copies of short and long texts, shared passages and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    for size in (2, 3, 5, 9, 11, 13, 20, 25, 40, 80, 200):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(n // 10):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(w))
                action = rng.random()
                if action < 0.5:
                    w[at] = rng.choice(vocabulary)
                elif action < 0.75:
                    w.insert(at, rng.choice(vocabulary))
                elif len(w) > 1:
                    del w[at]
            rows.append(" ".join(w).capitalize())
    rows += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(20)) for _ in range(15)]
    rows += ["", None, "   ", "one", "ONE", "one two", "one two", "a\tb\nc", "A b  c", "é É è"]
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


def resample(docs, target, share, longest, buckets, seed, least_words):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""

    def features(text):
        w = letters(text)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    def totals(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t):
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = totals(x for _, x in docs), totals(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for doc, text in docs:
        found = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(letters(text))])
    able = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1], -r[5]))
    for place, r in enumerate(able[: share[0] * len(able) // share[1]]):
        r[4] = place + 1
    return [tuple(r[:5]) for r in rows]


def repeated_lines(docs, least_chars, least_docs):
    """(doc_id, kept text, lines, dropped lines) of (doc_id, text) rows."""
    blanks = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            key = line.strip(blanks).translate(LOWER)
            if doc is not None and len(key) >= least_chars:
                holders[key].add(doc)
    out = []
    for doc, text in docs:
        split = (text or "").split("\n")
        kept = []
        for line in split:
            ids = holders.get(line.strip(blanks).translate(LOWER), ())
            if doc is None or len(ids) < least_docs or doc == max(ids):
                kept.append(line)
        out.append((doc, "\n".join(kept), len(split), len(split) - len(kept)))
    return out


def search(docs, items, k, b):
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text) rows."""
    bags = [(d, Counter(letters(t))) for d, t in docs]
    bags = [(d, c) for d, c in bags if c]
    total, df = sum(sum(c.values()) for _, c in bags), Counter(t for _, c in bags for t in c)
    n_docs, out = len(bags), []
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    for item, text in items:
        found = []
        for doc, c in bags:
            m = 100 - b + (b * sum(c.values()) * n_docs) // total
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in letters(text) if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -s) for i, (s, none, doc) in enumerate(sorted(found)[:k])]
    return out


def ftrl(rows, alpha, beta, l1, l2, toxic_weight):
    """Weights by coordinate, and the intercept, of FTRL-proximal over (label, coordinates) rows, a coordinate at a time."""
    z, n, bias, bias_n = defaultdict(float), defaultdict(float), 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for label, at in rows:
        w = {i: weight(i) for i in at}
        g = (1 / (1 + math.exp(-(bias + sum(w.values())))) - label) * (toxic_weight if label else 1)
        for i in at:
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
            n[i] += g * g
        bias_n += g * g
        bias -= alpha * g / (beta + math.sqrt(bias_n))
    return {i: weight(i) for i in sorted(z) if weight(i)}, bias
