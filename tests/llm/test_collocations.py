"""Phrase collocations against a plain version."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fondscope.llm import collocations as C

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def counted(rows):
    f = Counter()
    for text, lang in rows:
        for w in pieces(text):
            f.update((lang or "und", *w[k : k + n]) for n in range(1, 5) for k in range(len(w) - n + 1))
    return f


def plain(rows, least, top):
    f = counted(rows)
    total = Counter()
    for key, n in f.items():
        total[key[0]] += n * (len(key) == 2)
    covers = Counter()
    for (lang, *w), a in f.items():
        if a >= least:
            for n in range(2, len(w)):
                for k in range(len(w) - n + 1):
                    covers[lang, *w[k : k + n]] = max(covers[lang, *w[k : k + n]], a)
    out = {}
    for (lang, *w), a in f.items():
        if a >= least and len(w) > 1 and 100 * covers[lang, *w] < 80 * a:
            score, _, left, right = min((2000000 * a // (x + y), k, x, y) for k in range(1, len(w)) for x, y in [(f[lang, *w[:k]], f[lang, *w[k:]])])
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, k + 1, p.decode(), -a, x, y, total[lang], -s) for lang, found in out.items() for k, (s, a, p, x, y) in enumerate(sorted(found)[:top]))


def test_collocations(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    for least, top in ((30, 2000), (5, 40), (3, 7)):
        want = plain(rows, least, top)
        assert sorted(map(tuple, C.collocations(docs.repartition(3), least, top).collect())) == want and want


def test_odd_texts(spark):
    rows = [(None, "en"), ("", "en"), (" \t", None), ("a b. a b, A B", None), ("one two\tthree one  two\nthree", "en"), ("é È a b", "und"), ("w " * 40000, "x"), ("y" * 70000, "x"), ("p q r s t p q r s t", "en"), ("p q r s t p q r s t", "en"), ("-", "e n"), (".,;", "q")]
    d = spark.createDataFrame([(*r, 1, "h", "w", 2, 3) for r in rows], "text string, lang string, doc_id long, h string, w1 string, n int, f int")
    for least in (1, 2, 4):
        assert sorted(map(tuple, C.collocations(d, least).collect())) == plain(rows, least, 2000)
    assert C.collocations(d, 10**6).count() == 0 and C.collocations(d.filter("false")).count() == 0


@pytest.mark.parametrize("held", [4, 7, 10**6])
def test_windows_across_blocks(monkeypatch, held):
    """Blocks of a few bytes and batches of few texts give the counts of the whole, with any filter."""
    monkeypatch.setattr(C, "BLOCK", 9)
    monkeypatch.setattr(C, "HELD", held)
    texts = [("a b c d e f", "x"), ("", "x"), ("a b", "y"), ("c. a b c a b c d, e", "x"), (None, "y"), ("longer-than-a-block word", "x"), ("a", "x"), ("b c", "x")]
    batches = [pa.RecordBatch.from_arrays([pa.array([t for t, _ in texts[k : k + 3]], pa.string()), pa.array([g for _, g in texts[k : k + 3]])], ["text", "lang"]) for k in range(0, len(texts), 3)]
    names = {}
    for b in C._words_of(iter(batches), 1):
        for lang, h, word in zip(*(b.column(c).to_pylist() for c in ("lang", "h", "word")), strict=True):
            assert names.setdefault(h, (lang, word)) == (lang, word)
    got = Counter()
    for b in C._windows_of(iter(batches), 1):
        for lang, *w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            key = (lang, *(names[h][1] for h in w if h))
            for k in range(2, len(key) + 1):
                got[key[:k]] += n
    assert got == counted(texts)
    for m in (2, 3):
        grams = Counter()
        for b in C._grams_of(iter(batches), 1, *[np.full(8, 255, np.uint8)] * (m - 1)):
            for h, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                grams[h] += n
        assert sorted(grams.values()) == sorted(n for key, n in counted(texts).items() if len(key) == m + 1)


def test_filters_end_windows():
    """A word, pair or triple that a filter stops ends the window before its last word; all else stays."""
    h = np.arange(1, 7, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    piece = np.array([1, 1, 1, 1, 1, 2])

    def stopping(key):
        bits = np.full(1 << 12, 255, np.uint8)
        place = int(key) & (8 * len(bits) - 1)
        bits[place >> 3] ^= np.uint8(1 << (place & 7))
        return bits

    def lengths(*filters):
        return [int((row != 0).sum()) for row in C.windows(h, piece, filters)]

    every = np.full(1 << 12, 255, np.uint8)
    pair = C.pair_keys(h[:-1], h[1:])
    assert lengths() == lengths(every, every, every) == [4, 4, 3, 2, 1, 1]
    assert lengths(stopping(h[2])) == [2, 1, 0, 2, 1, 1]
    assert lengths(every, stopping(pair[1])) == [2, 1, 3, 2, 1, 1]
    assert lengths(every, every, stopping(C.pair_keys(pair[:-1], h[2:])[1])) == [3, 2, 3, 2, 1, 1]


def test_scores_pass_64_bits(spark):
    phrases = spark.createDataFrame([("x", [1], 6 * 10**18), ("x", [2], 3 * 10**18), ("x", [3], 10**18), ("x", [1, 2], 2 * 10**18), ("x", [2, 3], 10**18), ("x", [1, 2, 3], 9 * 10**17)], "lang string, w array<long>, f long")
    out = {tuple(r.w): (r.a, r.l, r.r, r.score) for r in C.scored(C.uncovered(phrases), phrases).collect()}
    assert out == {(1, 2): (2 * 10**18, 6 * 10**18, 3 * 10**18, 444444), (1, 2, 3): (9 * 10**17, 6 * 10**18, 10**18, 257142)}
