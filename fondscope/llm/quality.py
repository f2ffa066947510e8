"""Operator 4: quality from compression. Two zstandard dictionaries, of good and of bad labelled text; the normalized difference
of the sizes to which they compress a text becomes a calibrated score."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small_batches

#: Training draws at most this many labelled texts of each class, each of at most so many characters.
PER_CLASS, LONGEST = 1500, 16384
#: Bytes of a dictionary, and of the blocks that are compressed one by one (so that a long text can't become its own dictionary).
DICTIONARY, BLOCK, LEVEL = 1 << 16, 2048, 3
KEEP = 0.7


class Model(NamedTuple):
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


_open: dict[bytes, object] = {}


def compressor(dictionary: bytes):
    import zstandard

    if dictionary not in _open:
        if len(_open) > 3:
            _open.clear()
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        params = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        if data:
            data.precompute_compress(level=LEVEL)
        _open[dictionary] = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, **params)
    return _open[dictionary]


def difference(text: str, good: bytes, bad: bytes) -> float:
    """(size with the bad dictionary - size with the good one) / their sum, over all blocks of the text; 0 if it is empty."""
    data = text.encode("utf-8", "replace")
    a, b = compressor(good), compressor(bad)
    x = y = 0
    for k in range(0, len(data), BLOCK):
        block = data[k : k + BLOCK]
        x += len(a.compress(block))
        y += len(b.compress(block))
    return (y - x) / (x + y) if data else 0.0


def dictionary(texts: list[str]) -> bytes:
    import zstandard

    blocks = [d[k : k + BLOCK] for d in (t.encode("utf-8", "replace") for t in texts) for k in range(0, len(d), BLOCK)]
    if not blocks:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too little text to choose from: all of it
        return b"".join(blocks)[-DICTIONARY:]


def measured(d: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What the calibration sees: the difference, a constant, and how short the text is (a few words say little)."""
    return np.stack([d * 100, np.ones_like(d), 64 / (64 + size)], 1)


def calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights of the logistic curve through (z, y), by Newton steps with a weak prior."""
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + 1e-2 * w
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(x) for x in w)


def trained(texts: list[str], labels: list[int]) -> Model:
    """Two thirds of the texts give the dictionaries, the others the calibration. With one class or none: its share."""
    use = [k for k in range(len(texts)) if k % 3]
    good, bad = (dictionary([texts[k] for k in use if labels[k] == q]) for q in (1, 0))
    rest = [k for k in range(len(texts)) if k % 3 == 0]
    y = np.array([labels[k] for k in rest], float)
    if not good or not bad or len(set(y)) < 2:
        return Model(b"", b"", (0.0, float(np.log((sum(labels) + 1) / (len(labels) - sum(labels) + 1))), 0.0))
    return Model(good, bad, calibrated(measured(*sizes([texts[k] for k in rest], good, bad)), y))


def sizes(texts: list[str], good: bytes, bad: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.array([difference(t, good, bad) for t in texts], float), np.array([len(t) for t in texts], float)


def chances(texts: list[str], model: Model) -> np.ndarray:
    z = measured(*sizes(texts, model.good, model.bad))
    return 1 / (1 + np.exp(-np.clip(z @ np.array(model.weights), -30, 30)))


def learned(docs: DataFrame, labels: DataFrame, remainder: int = 2, divisor: int = 4) -> Model:
    """Fit on labelled documents whose crc32(doc_id as text) mod `divisor` isn't `remainder`.

    At most 2 * PER_CLASS texts (by a hash of doc_id, in the classes' own proportion; none longer than LONGEST) reach the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1) and doc_id is not null")
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % divisor != remainder).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * PER_CLASS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull() & (F.length("text") <= LONGEST))
    rows = texts.join(F.broadcast(some), "doc_id").orderBy("doc_id", "text").limit(4 * PER_CLASS).collect()
    return trained([r.text for r in rows], [r.quality for r in rows])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row of `docs` (doc_id, text), from its whole text and nothing else.

    Null and empty texts get the score of a difference of 0; repeated rows and null doc_ids are scored like others; other
    columns are ignored.
    """
    small_batches(docs.sparkSession)

    def score(batches):
        for batch in batches:
            p = chances([t or "" for t in batch.column("text").to_pylist()], model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(score, "doc_id long, score double")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    made = scored(docs, learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return made.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
