"""Operator 2: token ids as packed binary matrices, by best-fit decreasing over each task's own pieces."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small_batches, text_or_empty
from .packing import best_fit_decreasing
from .tokens import CAPACITY, SEPARATOR, forgetting, ids_of, vocabulary

#: Ids that a task holds before it packs them (4 bytes each). Each such batch leaves about one sequence partly empty.
HELD = 1 << 22
_TYPES = {"ids": pa.binary(), "used": pa.int32(), "cu_seqlens": pa.list_(pa.int32()), "position_ids": pa.binary(), "doc_ids": pa.list_(pa.int64()), "pieces": pa.list_(pa.int32())}
SCHEMA = "ids binary, used int, cu_seqlens array<int>, position_ids binary, doc_ids array<long>, pieces array<int>"


def rows_of(pieces: list[tuple[int | None, int, bytes]], capacity: int) -> Iterator[tuple]:
    """The packed rows of some pieces (doc_id, piece, ids)."""
    lengths = np.array([len(p[2]) // 4 for p in pieces])
    counts = np.bincount(lengths)
    runs, bins = best_fit_decreasing({int(n): int(counts[n]) for n in np.flatnonzero(counts)}, capacity)
    queue = np.argsort(lengths, kind="stable")
    first = np.cumsum(counts) - counts
    held: list[list[tuple[int, int]]] = [[] for _ in range(bins)]
    for run in runs:
        for k in range(run.count):
            held[run.bin + k // run.each].append((run.offset + k % run.each * run.length, int(queue[first[run.length] + run.first + k])))
    for row in held:
        mine = [pieces[k] for _, k in sorted(row)]
        sizes = [len(p[2]) // 4 for p in mine]
        used = sum(sizes)
        ids = b"".join(p[2] for p in mine) + SEPARATOR.to_bytes(4, "little") * (capacity - used)
        places = np.concatenate([*(np.arange(n, dtype="<i4") for n in sizes), np.zeros(capacity - used, "<i4")])
        yield ids, used, np.cumsum([0, *sizes]).tolist(), places.tobytes(), [p[0] for p in mine], [p[1] for p in mine]


def packed_rows(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Packed rows of all documents (doc_id, text), one for each sequence of `capacity` ids.

    ids: the row of the id matrix, `capacity` little-endian unsigned 32-bit numbers, of which `used` are in use (the rest is
    SEPARATOR); cu_seqlens: where its segments begin, and `used`; position_ids: like ids, counted from 0 in each segment;
    doc_ids and pieces: each segment's document and its number there. A document is its ids and SEPARATOR, cut every `capacity`
    ids, so nothing is lost. Each task packs what it reads, by best-fit decreasing with the segment tree of `packing`: no id
    is shuffled, and a task holds HELD ids at most (or one document). Null texts count as empty; repeated rows are packed as often as they
    occur; null doc_ids are kept; no rows give no rows. Other columns are ignored.
    """
    path, step = path or vocabulary(), 4 * capacity
    small_batches(docs.sparkSession)

    def pack(batches):
        def emitted(pieces):
            rows = rows_of(pieces, capacity)
            while some := list(islice(rows, 256)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), _TYPES.values(), strict=True)], list(_TYPES))

        held, size = [], 0
        for batch in forgetting(path, batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = ids_of(text, path)
                held += [(doc_id, k, ids[at : at + step]) for k, at in enumerate(range(0, len(ids), step))]
                size += len(ids) // 4
                if size >= HELD:
                    yield from emitted(held)
                    held, size = [], 0
        if held:
            yield from emitted(held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(pack, SCHEMA)


def write_packed(docs: DataFrame, to: str, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Write the packed rows as Parquet files and read them again. Task retries replace a task's files as a whole."""
    packed_rows(docs, path, capacity).write.mode("overwrite").option("compression", "zstd").parquet(to)
    return docs.sparkSession.read.parquet(to)


def unpacked(rows: DataFrame) -> DataFrame:
    """(doc_id, piece, ids) of packed rows: the inverse of `packed_rows`, but for the order."""
    cut = F.transform(F.sequence(F.lit(1), F.size("doc_ids")), lambda k: F.struct(F.element_at("doc_ids", k).alias("doc_id"), F.element_at("pieces", k).alias("piece"), F.substring(F.col("ids"), F.element_at("cu_seqlens", k) * 4 + 1, (F.element_at("cu_seqlens", k + 1) - F.element_at("cu_seqlens", k)) * 4).alias("ids")))
    return rows.select(F.explode(cut).alias("x")).select("x.*")


def op2_packed_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows(documents(spark, sf_dir)).withColumn("row_id", F.monotonically_increasing_id())
