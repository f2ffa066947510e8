"""Operators 2, 4, 6 and 8 against plain versions of what they compute."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard

from fondscope.llm import language, packed_output, quality, sharding

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_packed_rows_are_those_of_plain_best_fit():
    """Sequences of the same fillings as putting each piece, the longest first, into the tightest sequence with room."""
    rng = random.Random(1)
    for capacity in (16, 64, 2048):
        pieces = [(k, 0, bytes(4 * rng.choice([rng.randint(1, capacity), rng.randint(1, 1 + capacity // 4)]))) for k in range(400)]
        free = []
        for n in sorted((len(p[2]) // 4 for p in pieces), reverse=True):
            fits = [k for k, f in enumerate(free) if f >= n]
            k = min(fits, key=lambda k: free[k]) if fits else len(free)
            free += [] if fits else [capacity]
            free[k] -= n
        rows = list(packed_output.rows_of(pieces, capacity))
        assert Counter(r[1] for r in rows) == Counter(capacity - f for f in free)
        assert sorted(d for r in rows for d in r[4]) == list(range(400)) and all(r[2][-1] == r[1] and len(r[0]) == 4 * capacity for r in rows)


def test_quality_scores_by_a_plain_loop(spark, docs):
    """Every text's blocks compressed one by one with each dictionary, and the logistic curve of the difference."""
    model = quality.learned(docs, spark.read.parquet(f"{SF}/labels.parquet"), -1)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "é" * 70000), (10**6 + 3, "word " * 200000)]
    made = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, score string")
    got = {r.doc_id: r.score for r in quality.scored(made, model).collect()}

    def size(data, dictionary):
        c = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=False, write_content_size=False, write_dict_id=False)
        return sum(len(c.compress(data[k : k + 2048])) for k in range(0, len(data), 2048))

    assert model.good and model.bad and len(got) == len(rows)
    for d, text in random.Random(2).sample(rows, 40) + rows[-4:]:
        data = (text or "").encode()
        x, y = size(data, model.good), size(data, model.bad)
        z = sum(w * v for w, v in zip(model.weights, ((y - x) / (x + y) * 100 if data else 0.0, 1.0, 64 / (64 + len(text or ""))), strict=True))
        assert math.isclose(got[d], 1 / (1 + math.exp(-z)), abs_tol=2e-3 if len(data) > 2048 else 1e-6), d


@pytest.mark.parametrize("hot", [False, True])
def test_law_of_shards_by_counting(spark, docs, hot):
    """Bytes of shards, slots and groups of equal texts, counted row by row."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    if hot:
        rows += [(5000 + k, "copy " * 40) for k in range(len(rows) // 2)] + [(9000, None), (9001, ""), (None, "x"), (1, rows[0][1])]
    n = 8
    out = sharding.shards(spark.createDataFrame([(d, t, 1, "r") for d, t in rows], "doc_id long, text string, shard int, row string").repartition(3), n).collect()
    size = lambda t: len((t or "").encode()) + 16
    assert Counter((r.doc_id, r["size"]) for r in out) == Counter((d, size(t)) for d, t in rows)
    slots, total, places = defaultdict(list), Counter(), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        total[r.shard] += r["size"]
        places[r.text_crc32, r["size"]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    share = sum(total.values()) / n
    groups = Counter()
    for d, t in rows:
        groups[t or ""] += size(t)
    most = max(b for b in groups.values() if b <= share)
    assert max(total.values()) - min(total[k] for k in range(n)) <= 2 * most
    import zlib

    for t, b in groups.items():
        if b <= share / 2:
            assert len(places[zlib.crc32(t.encode()), size(t)]) == 1


def test_languages_by_dense_features(spark, docs):
    """Shares of letters, pairs and triples in one dense row for each text, times the machines' weights; families, then votes."""
    model = language.learned(docs, -1)
    texts = [r.text for r in docs.collect()][::5] + ["", "123 !", "ein", "the " * 60000, "x" * 200000]
    got, _ = language.predicted(texts, model)
    kin = [language.family(k) for k in model.languages]
    for text, name in zip(texts, got, strict=True):
        if not any(c.isalpha() for c in text):
            assert name == language.UNKNOWN
            continue
        c = language.codes(text)
        row = np.zeros(language.ORDERS * language.BUCKETS)
        for b in language.buckets(c):
            np.add.at(row, b, 1 / (len(c) - 2))
        m = row @ model.weights.astype(float) + model.bias
        families = model.families or [kin[0]]
        best = families[int(m[: len(model.families)].argmax())] if model.families else families[0]
        votes = Counter({i: 0 for i, f in enumerate(kin) if f == best})
        for k, (i, j) in enumerate(model.pairs, len(model.families)):
            if kin[i] == best:
                votes[i if m[k] >= 0 else j] += 1
        top = max(votes.values())
        assert name in {model.languages[i] for i, v in votes.items() if v == top}
