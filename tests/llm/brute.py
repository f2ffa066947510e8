"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def similar(a, b):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 75 * (len(a) + len(b) - both)


def near(sets):
    """For each set, the earlier ones that share a shingle."""
    index = defaultdict(list)
    for k, s in enumerate(sets):
        yield k, {j for x in s for j in index[x]}
        for x in s:
            index[x].append(k)


def components(rows):
    """doc_id -> (set size, component) of rows (doc_id, text)."""
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingle_set(t) for _, t in rows]
    for k, others in near(sets):
        for j in others:
            if similar(sets[k], sets[j]):
                a, b = sorted((root(rows[k][0]), root(rows[j][0])))
                parent[b] = a
    return {d: (len(s), root(d)) for (d, _), s in zip(rows, sets, strict=True)}


def removed_lines(rows):
    """doc_id -> numbers of the lines that match an earlier line, of rows (doc_id, text) in order of doc_id."""
    lines = [(d, k, shingle_set(line)) for d, t in sorted(rows) for k, line in enumerate((t or "").split("\n"))]
    out = defaultdict(list)
    sets = [s for _, _, s in lines]
    for k, others in near(sets):
        if any(similar(sets[k], sets[j]) for j in others):
            out[lines[k][0]].append(lines[k][1])
    return dict(out)


def bm25(rows, queries, k=10):
    """query_id -> [(doc_id, score)]."""
    docs = [(d, Counter(words(t))) for d, t in rows]
    n = len(docs)
    average = sum(sum(c.values()) for _, c in docs) / max(1, n)
    df = Counter(w for _, c in docs for w in c)
    idf = {w: math.log(1 + (n - x + 0.5) / (x + 0.5)) for w, x in df.items()}
    out = {}
    for q, text in queries:
        score = []
        for d, c in docs:
            size = sum(c.values())
            s = sum(m * idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size / average)) for w, m in Counter(words(text)).items() if w in c)
            if s > 0:
                score.append((-round(s, 6), d))
        out[q] = [(d, -s) for s, d in sorted(score)[:k]]
    return out


def best_fit(lengths, capacity):
    """How many bins best-fit decreasing opens."""
    bins = []
    for x in sorted(lengths, reverse=True):
        fit = [(left, k) for k, left in enumerate(bins) if left >= x]
        if fit:
            bins[min(fit)[1]] -= x
        else:
            bins.append(capacity - x)
    return len(bins)


def contaminated(rows, items):
    """(doc_id, item_id) where some item-sized window's weighted shingles are similar enough."""
    out = set()
    for d, text in rows:
        w = words(text)
        for i, item in items:
            v = words(item)
            m = len(v)
            grams = lambda x: Counter(tuple(x[k : k + 5]) for k in range(len(x) - 4)) if len(x) >= 5 else Counter([tuple(x)] if x else [])
            b = grams(v)
            if not set(b) & set(grams(w)):
                continue
            for a in range(max(1, len(w) - m + 1)):
                g = grams(w[a : a + m])
                least = sum((g & b).values())
                if least and 100 * least >= 75 * (sum(g.values()) + sum(b.values()) - least):
                    out.add((d, i))
                    break
    return out


def contaminated_with_cuts(rows, items):
    """As `contaminated`, with windows that are cut at the document's ends, for documents of any length, and with shingles of the
    item's length where it has fewer than five words."""
    out = set()
    for d, text in rows:
        w = words(text)
        for i, item in items:
            v = words(item)
            m = len(v)
            n = max(1, min(5, m))
            grams = lambda x, n=n: Counter(tuple(x[k : k + n]) for k in range(len(x) - n + 1)) if len(x) >= n else Counter([tuple(x)] if x else [])
            b = grams(v)
            for a in range(1 - m, len(w)):
                g = grams(w[max(a, 0) : a + m])
                least = sum((g & b).values())
                if least and 100 * least >= 75 * (sum(g.values()) + sum(b.values()) - least):
                    out.add((d, i))
                    break
    return out
