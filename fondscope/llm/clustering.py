"""Operator 11: exact k-means whose rounds scan only ambiguous vectors.

A vector keeps its cluster, its exact distance and a lower bound on its distance to every other centroid. When centroids move, the
bound has to be loosened by how much nearer another centroid can have come. Full drift would do, but a cluster's vectors all lie
in a sphere around its centroid, and seen from there most centroids move sideways. With m the middle of a centroid's way from p to q,
and t the angle at m between the way and a vector x: |x - p| - |x - q| = 2 |x - m| |p - q| cos t / (|x - p| + |x - q|), which is at
most |p - q| cos t, as the sum below is at least 2 |x - m|. In the plane of the way and the sphere's centre, the vectors of the
sphere have an angle of at least that of the centre less asin(radius / distance of the centre from m). Vectors that the loosened
bound doesn't decide are scanned exactly, in integers, so the result is that of plain k-means.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import removed, stored

COMPONENTS = 64
CENTROIDS, ROUNDS, SEED = 40, 5, "2"
SCALE = 256
#: Integers up to this give squared distances of 64 components that fit 64 bits; up to EXACT ones that doubles hold exactly.
MOST, EXACT = 1 << 27, 1 << 22
#: What rounding may add to a bound: relative, and absolute (distances of different integer vectors are 1 at least).
REL, ABS = 1e-9, 1e-6
STATE = "vec_id long, v binary, cluster int, distance long, lower double, scanned boolean"


class Sums(NamedTuple):
    """Of a cluster: its vectors, their componentwise sums, the sum and the greatest of their squared distances, and how many were scanned."""

    n: int
    sums: list[int]
    inertia: int
    widest: int
    scanned: int


def integers(embeddings: DataFrame, size: int = COMPONENTS) -> DataFrame:
    """(vec_id, v): the kept vectors of `embeddings` (vec_id, embedding) as little-endian 32-bit integers floor(SCALE * x).

    Kept are vectors of exactly `size` components, none of them null or non-finite, nor so large (beyond +-MOST once scaled) that
    a squared distance fits no 64-bit integer. Null vec_ids and repeated rows are kept.
    """

    def keep(batches):
        for batch in batches:
            column = batch.column(1)
            rows = np.flatnonzero(pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False) == size)
            x = column.take(pa.array(rows)).flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, size)
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(x * SCALE)
                good = (np.abs(x) <= MOST).all(axis=1)
            v = np.ascontiguousarray(x[good], "<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[good])), pa.array(list(map(bytes, v)), pa.binary())], ["vec_id", "v"])

    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(keep, "vec_id long, v binary")


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a column of `integers`, one a row."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, size)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of v from all rows of c."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= EXACT:
        a, b = v.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    a = v.astype(np.int64)
    return np.stack([np.square(a - x).sum(axis=1) for x in c.astype(np.int64)], axis=1)


def nearest(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of v the nearest row of c (of equally near ones the first), its squared distance, and the distance of the next."""
    d, rows = squared(v, c), np.arange(len(v))
    best = d.argmin(axis=1)
    own = d[rows, best]
    d[rows, best] = np.iinfo(np.int64).max
    return best, own, np.sqrt(d.min(axis=1).astype(np.float64)) if len(c) > 1 else np.full(len(v), np.inf)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, by how much nearer any other centroid can have come to a vector within `radius` of the cluster's old
    centroid, when centroids move from `old` to `new`."""
    old, new = old.astype(np.float64), new.astype(np.float64)
    way = new - old
    drift = np.sqrt((way * way).sum(axis=1))
    middle = (old + new) / 2
    out = np.zeros((len(old), len(old)))
    for j in np.flatnonzero(drift > 0):
        to = old - middle[j]
        far = np.sqrt((to * to).sum(axis=1))
        apart = far > radius
        with np.errstate(divide="ignore", invalid="ignore"):
            centre = np.arccos(np.clip(to @ way[j] / (far * drift[j]), -1, 1))
            least = np.maximum(0, centre - np.arcsin(np.minimum(1, radius / far)))
        out[:, j] = np.where(apart, drift[j] * np.maximum(0, np.cos(least)), drift[j])
    np.fill_diagonal(out, 0)
    return out.max(axis=1, initial=0) * (1 + REL) + ABS


def assigned(state: DataFrame, centroids: np.ndarray, loose: np.ndarray | None = None, size: int = COMPONENTS) -> DataFrame:
    """STATE of each vector after the centroids have moved to `centroids`; `loose`: how much looser each cluster's bounds are now.
    Without it, as for vectors that have no state yet, all are scanned."""
    columns = [f.split()[0] for f in STATE.split(", ")]

    def assign(batches):
        for batch in batches:
            v = matrix(batch.column("v"), size)
            if loose is None:
                cluster, own, lower = nearest(v, centroids)
                scanned = np.ones(len(v), bool)
            else:
                cluster = batch.column("cluster").to_numpy().astype(np.int64)
                lower = batch.column("lower").to_numpy() - loose[cluster]
                own = np.square(v.astype(np.int64) - centroids[cluster]).sum(axis=1)
                scanned = ~(np.sqrt(own.astype(np.float64)) * (1 + REL) + ABS < lower)
                if scanned.any():
                    cluster[scanned], own[scanned], lower[scanned] = nearest(v[scanned], centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(cluster.astype(np.int32)), pa.array(own), pa.array(lower), pa.array(scanned)], columns)

    return state.mapInArrow(assign, STATE)


def cluster_sums(state: DataFrame, size: int = COMPONENTS) -> dict[int, Sums]:
    """Sums of each cluster that has vectors. Tasks add up their own vectors; a row of each task and cluster is shuffled."""

    def add(batches):
        for batch in batches:
            v, cluster, d, scanned = matrix(batch.column("v"), size), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "distance", "scanned"))
            for k in np.unique(cluster):
                own = cluster == k
                yield pa.RecordBatch.from_pylist([{"cluster": int(k), "n": int(own.sum()), "sums": v[own].sum(axis=0, dtype=np.int64).tolist(), "inertia": sum(d[own].tolist()), "widest": int(d[own].max()), "scanned": int(scanned[own].sum())}], schema)

    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("inertia", pa.decimal128(38, 0)), ("widest", pa.int64()), ("scanned", pa.int64())])
    parts = state.select("v", "cluster", "distance", "scanned").mapInArrow(add, "cluster int, n long, sums array<long>, inertia decimal(38,0), widest long, scanned long")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(size)), F.sum("inertia").alias("inertia"), F.max("widest").alias("widest"), F.sum("scanned").alias("scanned"))
    return {r.cluster: Sums(r.n, [int(r[f"s{i}"]) for i in range(size)], int(r.inertia), r.widest, r.scanned) for r in total.collect()}  # a row for each centroid


def moved(centroids: np.ndarray, sums: dict[int, Sums]) -> np.ndarray:
    """Each non-empty cluster's exact mean, rounded down; centroids of empty ones stay."""
    return np.array([[s // sums[k].n for s in sums[k].sums] if k in sums else row.tolist() for k, row in enumerate(centroids)], np.int64).reshape(centroids.shape)


def clusters(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, size: int = COMPONENTS) -> tuple[DataFrame, np.ndarray, dict[int, Sums], list[int]]:
    """STATE of all kept vectors, the final centroids, the clusters' sums, and how many vectors each round scanned.

    The first centroids are the kept vectors whose `seed:vec_id` has the least digests; with fewer vectors there are fewer. Vectors without
    a vec_id can't be among them; of repeated vec_ids the smaller bytes come first. Each round's state is written before the
    one before it is removed, so lost executors cost a retry of a task. Only k rows, whatever the input's size, reach the driver.
    """
    vectors, path = stored(integers(embeddings, size), "vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.filter("vec_id is not null").select(digest.alias("digest"), "v").orderBy("digest", "v").limit(k).collect()
    centroids, loose, scans, state, sums = np.array([np.frombuffer(r.v, "<i4") for r in first], np.int64).reshape(-1, size), None, [], vectors, {}
    if not first:
        return assigned(vectors.limit(0), np.zeros((1, size), np.int64), None, size), centroids, sums, scans
    for at in range(rounds + 1):
        state, now = stored(assigned(state, centroids, loose, size), "state")
        removed(vectors.sparkSession, path)
        path, sums = now, cluster_sums(state, size)
        scans.append(sum(s.scanned for s in sums.values()))
        if at < rounds:
            radius = np.array([np.sqrt(float(sums[i].widest)) if i in sums else 0.0 for i in range(len(centroids))])
            old, centroids = centroids, moved(centroids, sums)
            loose = loosening(old, centroids, radius * (1 + REL))
    return state, centroids, sums, scans


def centroid_digest(c: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()


def clustered(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, size: int = COMPONENTS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector of `embeddings` (vec_id, embedding).

    Repeated rows count as often as they occur; null vec_ids are clustered, but aren't first centroids (a table of nothing else gives
    no rows, as does an empty one). Other columns are ignored.
    """
    state, centroids, sums, _ = clusters(embeddings, k, rounds, seed, size)
    total = sum(s.inertia for s in sums.values())
    rows = [(i, s.inertia, total, centroid_digest(centroids[i].tolist())) for i, s in sorted(sums.items())]
    about = embeddings.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row for each centroid


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
