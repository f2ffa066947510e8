"""Versions of files of any size, from tasks that each read a range of a file.

A file is the sequence of its lines. Each line has RESIDUES numbers below P from its MD5 digest, and a sequence of lines has, for each
of them, the value of the polynomial with these numbers as coefficients at a fixed place. Values of neighbouring ranges are put together
by one multiplication, in order and however the file is cut: so the result doesn't depend on the cluster, and no task
reads more than its range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

P = (1 << 31) - 1
#: Where the polynomials are evaluated, one for each 32 bits of a line's digest.
PLACES = (1_103_515_245, 1_664_525, 214_013, 69_069)
RESIDUES = len(PLACES)
_RANGE = "file_key long, block long, lines long, bytes long, power array<long>, value array<long>"


def powers(n: int) -> np.ndarray:
    """PLACES to the powers 0 to n - 1, modulo P."""
    out = np.ones((n, RESIDUES), np.uint64)
    for k in range(1, n):
        out[k] = out[k - 1] * np.array(PLACES, np.uint64) % np.uint64(P)
    return out


def _ranges(batches):
    """One row for each range of a file: a task's lines come in order, a range after the other."""
    table, now, state = powers(1), None, None
    schema = pa.schema([("file_key", pa.int64()), ("block", pa.int64()), ("lines", pa.int64()), ("bytes", pa.int64()), ("power", pa.list_(pa.int64())), ("value", pa.list_(pa.int64()))])

    def row():
        lines, size, power, value = state
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*now, lines, size, power.astype(np.int64).tolist(), value.astype(np.int64).tolist()), schema, strict=True)], schema=schema)

    for batch in batches:
        key, block, size = (batch.column(c).to_numpy() for c in ("file_key", "block", "bytes"))
        digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), ">u4").reshape(-1, RESIDUES).astype(np.uint64) % np.uint64(P)
        if len(table) <= len(key):
            table = powers(len(key) + 1)
        cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]) if len(key) else []
        for a, z in zip(cuts, [*cuts[1:], len(key)], strict=True):
            if now != (key[a], block[a]):
                if now is not None:
                    yield row()
                now, state = (int(key[a]), int(block[a])), (0, 0, np.ones(RESIDUES, np.uint64), np.zeros(RESIDUES, np.uint64))
            n = z - a
            value = (digests[a:z] * table[n - 1 :: -1][:n] % np.uint64(P)).sum(axis=0) % np.uint64(P)
            lines, total, power, before = state
            state = (lines + int(n), total + int(size[a:z].sum()), power * table[n] % np.uint64(P), (before * table[n] + value) % np.uint64(P))
    if now is not None:
        yield row()


def content_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, lines, bytes, digest) of each file that `path` names, of any size and content; empty files, which scans pass over, have no row.

    Lines end at line feeds, and `bytes` are theirs with one more each. Of binary files that is as good a cut as any, as long as
    no stretch without a line feed is larger than 2 GB. Files that Spark decompresses by their names are fingerprinted by what they hold.
    Only 16 bytes of each line leave the JVM, and a row for each range is shuffled.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.xxhash64("_metadata.file_path").alias("file_key"), F.col("_metadata.file_block_start").alias("block"), (F.octet_length("value") + 1).cast("long").alias("bytes"), F.unhex(F.md5(F.col("value").cast("binary"))).alias("digest"))
    ranges = lines.mapInArrow(_ranges, _RANGE).groupBy("file_key").agg(F.sort_array(F.collect_list(F.struct("block", "lines", "bytes", "power", "value"))).alias("ranges"))
    start = F.array(*(F.lit(0).cast("long") for _ in PLACES))
    value = F.aggregate("ranges", start, lambda acc, r: F.transform(acc, lambda x, k: (x * F.get(r["power"], k) + F.get(r["value"], k)) % P))
    total = lambda c: F.aggregate("ranges", F.lit(0).cast("long"), lambda acc, r: acc + r[c])
    made = ranges.select("file_key", total("lines").alias("lines"), total("bytes").alias("bytes"), F.array_join(F.transform(value, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "").alias("digest"))
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.xxhash64("path").alias("file_key"), F.col("length").alias("size"))
    return files.join(made, "file_key").select("file", "size", "lines", "bytes", "digest")
