"""Operator 10: best-fit-decreasing packing of token pieces into sequences.

Which bin a piece goes to depends on lengths only, and those are whole numbers up to the capacity. So the packing is decided
on the counts of the lengths (at most `capacity` numbers), for whole runs of equal pieces and of equal bins at once, and
each piece then finds its place by its rank among the pieces of its length. The result is that of best-fit decreasing over
all pieces in one list, though no task and no driver ever holds the pieces.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, partitions, written
from .tokens import CAPACITY, pieces, vocabulary


class Run(NamedTuple):
    """Pieces first..first+count-1 of a length go to bins bin, bin+1, ..., `each` to a bin, from place `offset` on."""

    length: int
    first: int
    count: int
    bin: int
    each: int
    offset: int


class Capacities:
    """Segment tree over remaining capacities: which of them open bins have, and the tightest that fits a length."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, left: int, first: int, count: int) -> None:
        if left and count:
            self.bins[left].append((first, count))
            self._mark(left, True)

    def take(self, left: int) -> tuple[int, int]:
        first, count = self.bins[left].pop()
        if not self.bins[left]:
            self._mark(left, False)
        return first, count

    def _mark(self, left: int, value: bool) -> None:
        k = self.size + left
        self.open[k] = value
        while k > 1:
            k //= 2
            self.open[k] = self.open[2 * k] or self.open[2 * k + 1]

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open bin that is at least `length`, in logarithmic time."""
        k = self.size + length
        if self.open[k]:
            return length
        while k > 1:
            if k % 2 == 0 and self.open[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.open[2 * k] else 2 * k + 1
                return k - self.size
            k //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Runs of the packing for so many pieces of each length, and how many bins it opens."""
    tree, runs, bins = Capacities(capacity), [], 0
    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            left = tree.tightest(length)
            if left is None:
                first, have, left = bins, -(-(total - done) // (capacity // length)), capacity
                bins += have
            else:
                first, have = tree.take(left)
            each = left // length
            full = min(have, (total - done) // each)
            if full:
                runs.append(Run(length, done, full * each, first, each, capacity - left))
                tree.add(left - each * length, first, full)
                done += full * each
            rest = min(total - done, each - 1) if full < have else 0
            if rest:  # the last pieces of this length, in one bin that they don't fill
                runs.append(Run(length, done, rest, first + full, each, capacity - left))
                tree.add(left - rest * length, first + full, 1)
                done += rest
                full += 1
            tree.add(left, first + full, have - full)
    return runs, bins


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of `cut` (doc_id, piece, length, ids_crc32, ...; 1 <= length <= capacity) with sequence_id and offset.

    Ranks among equal lengths are counted in buckets of (doc_id, piece), so a length that most pieces have is no hot group.
    `cut` must be a written table: it is read more than once and every reading must give the same rows.
    """
    spark = cut.sparkSession
    buckets = 4 * partitions(spark)
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = written(cut.groupBy("bucket", "length").count(), "lengths")
    totals = {int(r.length): int(r.n) for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most `capacity` rows
    runs, _ = best_fit_decreasing(totals, capacity)
    table = np.array(sorted(runs), np.int64).reshape(-1, len(Run._fields))
    starts = np.searchsorted(table[:, 0], np.arange(capacity + 2))

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("bucket", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.repartition(buckets, "bucket").withColumn("nth", F.row_number().over(order) - 1)
    ranked = ranked.join(counts, ["bucket", "length"]).withColumn("rank", (F.col("before") + F.col("nth")).cast("long")).drop("before", "nth", "bucket")

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                mine, lo, hi = length == x, starts[x], starts[x + 1]
                row[mine] = lo + np.searchsorted(table[lo:hi, 1], rank[mine], "right") - 1
            run, nth = table[row], rank - table[row, 1]
            keep = [k for k in batch.schema.names if k != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(run[:, 3] + nth // run[:, 4]), pa.array(run[:, 5] + nth % run[:, 4] * length)], [*keep, "sequence_id", "offset"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, f"{kept}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): all documents (doc_id, text), packed.

    Only documents of more than `capacity` ids are cut. Null texts count as empty (one id); null doc_ids are packed like
    others; repeated rows are packed as often as they occur; an empty table gives no rows. Other columns are ignored.
    """
    return placed(written(pieces(docs, path or vocabulary(), capacity), "pieces"), capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
