"""Exact k-means against a plain version, and its bounds."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from fondscope.llm import clustering as C

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance string"


def plain(rows, k, rounds):
    """cluster, distance and final centroids of rows (vec_id, integers), as the rounds say."""
    order = sorted(rows, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())
    centroids = [v for _, v in order[:k]]
    for at in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids)) for _, v in rows]
        if at < rounds:
            for i in range(len(centroids)):
                own = [v for (_, v), (_, j) in zip(rows, found, strict=True) if i == j]
                if own:
                    centroids[i] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return found, centroids


def test_clusters(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, [math.floor(256 * x) for x in r.embedding]) for r in e.collect()]
    found, centroids = plain(rows, 7, 3)
    out = {r.vec_id: r for r in C.clustered(e, k=7, rounds=3).collect()}
    assert [(out[d].distance, out[d].cluster) for d, _ in rows] == found
    assert {r.inertia for r in out.values()} == {sum(d for d, _ in found)}
    for i, c in enumerate(centroids):
        mine = [r for r in out.values() if r.cluster == i]
        assert {r.cluster_inertia for r in mine} <= {sum(r.distance for r in mine)} and {r.centroid_sha256 for r in mine} <= {hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()}


def test_rounds_skip_what_bounds_decide(spark):
    """Well-separated groups: after the first round few vectors are scanned again, and the result stays exact."""
    rng = np.random.default_rng(3)
    at = rng.normal(size=(9, 64)) * 3
    rows = [(k, (at[k % 9] + rng.normal(size=64) * 0.05).tolist(), 0, 0, "") for k in range(900)]
    state, centroids, sums, scans = C.clusters(spark.createDataFrame(rows, SCHEMA).repartition(3), k=12)
    got = state.toPandas()
    v = np.stack([np.frombuffer(x, "<i4") for x in got.v])
    best, own, _ = C.nearest(v, centroids)
    assert scans[0] == 900 and sum(scans[1:]) < 900 * 2
    assert got.cluster.tolist() == best.tolist() and got.distance.tolist() == own.tolist()
    assert sum(s.n for s in sums.values()) == 900


def test_loosening_holds_and_is_less_than_drift():
    rng = np.random.default_rng(1)
    less = 0
    for _ in range(300):
        old = rng.normal(size=(2, 5)) * 10
        new = old + rng.normal(size=(2, 5)) * rng.choice([0.0, 0.1, 3.0])
        radius = np.array([rng.choice([0.0, 0.5, 4.0, 40.0])] * 2)
        x = rng.normal(size=(400, 5))
        x = old[0] + x / np.linalg.norm(x, axis=1)[:, None] * radius[0] * rng.random((400, 1))
        nearer = np.linalg.norm(x - old[1], axis=1) - np.linalg.norm(x - new[1], axis=1)
        bound = C.loosening(old, new, radius)[0]
        assert nearer.max() <= bound
        less += bound < 0.9 * np.linalg.norm(new[1] - old[1])
    assert less > 30


def test_odd_vectors(spark):
    """Null, short, long, non-finite and huge vectors are left out; repeated rows and null ids count; large values are exact."""
    one, nan, inf = [0.5] * 64, float("nan"), float("inf")
    rows = [(1, one), (1, one), (2, [0.25] * 64), (None, one), (3, None), (4, []), (5, one[:63]), (6, [*one, 0.5]), (7, [nan, *one[1:]]), (8, [-inf, *one[1:]]), (9, [None, *one[1:]]), (10, [1e30, *one[1:]]), (11, [-400000.0] * 64), (None, [400000.0, *one[1:]])]
    d = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    out = sorted((str(r.vec_id), r.cluster, r.distance) for r in C.clustered(d, k=2, rounds=0).collect())
    kept = [(k, [math.floor(256 * x) for x in v]) for k, v in rows if k in (1, 2, 11)]
    seeds = [v for _, v in sorted(kept, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())[:2]]
    every = [*kept, (None, [128] * 64), (None, [102400000, *[128] * 63])]
    want = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(seeds)) for _, v in every]
    assert out == sorted((str(k), i, n) for (k, _), (n, i) in zip(every, want, strict=True))
    nothing = C.clustered(d.filter("false"))
    assert nothing.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and nothing.count() == 0
    assert C.clustered(d.filter(F.col("vec_id").isNull())).count() == 0
    assert {r.cluster for r in C.clustered(d.filter("vec_id = 1"), k=5).collect()} == {0}
