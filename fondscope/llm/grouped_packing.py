"""Operator 12: first-fit-decreasing packing in randomised groups, with a tournament tree of bin capacities.

Groups are packed by themselves, so no task sees more than a group and no packing waits for another. One document in FILLERS is
set aside with its ids: it may be cut anywhere, and fills what first-fit decreasing leaves free.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_tokens import encoder
from .common import documents, small_batches, text_or_empty, written
from .tokens import CAPACITY, vocabulary

VOCABULARY, END = "byte_bpe_50k.json", 1
#: Pieces of a group, about; of every so many documents one is a filler; and free places from which a sequence is filled.
GROUP, FILLERS, LEAST = 1 << 14, 8, 8
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tournament:
    """The bins' free capacities; each node above them holds the greater of its two, so the first bin with room for a length is
    found in logarithmic time."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.size)

    def first(self, length: int) -> int:
        k = 1
        while k < self.size:
            k *= 2
            if self.free[k] < length:
                k += 1
        return k - self.size

    def take(self, bin: int, length: int) -> None:
        k = self.size + bin
        self.free[k] -= length
        while k > 1:
            k //= 2
            most = max(self.free[2 * k], self.free[2 * k + 1])
            if self.free[k] == most:
                break
            self.free[k] = most


def first_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece (1 <= length <= capacity), and what each opened bin holds. Equal lengths go together: the first bin
    that one fits in takes as many as fit."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, at = Tournament(len(lengths), capacity), 0
    sizes, counts = np.unique(-lengths, return_counts=True)
    for length, count in zip((-sizes).tolist(), counts.tolist(), strict=True):
        end = at + count
        while at < end:
            bin = tree.first(length)
            free = tree.free[tree.size + bin]
            n = min(free // length, end - at)
            bins[order[at : at + n]] = bin
            offsets[order[at : at + n]] = capacity - free + length * np.arange(n)
            tree.take(bin, n * length)
            at += n
    used = capacity - np.array(tree.free[tree.size : tree.size + int(bins.max(initial=-1)) + 1], np.int64)
    return bins, offsets, used


class Part(NamedTuple):
    """A cut of filler `row`: places start..start+length of its ids, and where they go."""

    row: int
    start: int
    length: int
    bin: int
    offset: int


def filled(used: np.ndarray, fillers: list[int], capacity: int = CAPACITY, least: int = LEAST) -> Iterator[Part]:
    """Cuts of fillers of these lengths: first into bins with at least `least` places free, then into new ones. What remains for the
    last of these goes to sequences of powers of two, which need no padding."""
    left = sum(fillers)
    spaces: list[tuple[int, int, int]] = []
    for bin, have in enumerate(used.tolist()):
        take = min(left, capacity - have)
        if capacity - have >= least and take:
            spaces.append((bin, have, take))
            left -= take
    bin = len(used)
    while left:
        take = capacity if left >= capacity else 1 << (left.bit_length() - 1)
        spaces.append((bin, 0, take))
        bin, left = bin + 1, left - take
    row, start = 0, 0
    for bin, offset, take in spaces:
        while take:
            while start == fillers[row]:
                row, start = row + 1, 0
            n = min(take, fillers[row] - start)
            yield Part(row, start, n, bin, offset)
            start, offset, take = start + n, offset + n, take - n


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, every: int = FILLERS) -> DataFrame:
    """PIECES of each row of `docs` (doc_id, text): its ids and END, cut every `capacity`. The last piece of each `every`-th document that a task
    reads has its ids, if it is shorter than `capacity`."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    step = 4 * capacity
    types = [pa.int64()] * 5 + [pa.binary()]
    names = [c.split()[0] for c in PIECES.split(", ")]

    def rows(batch: pa.RecordBatch, seen: int) -> Iterable[tuple]:
        encode, end = encoder(path), END.to_bytes(4, "little")
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = encode(text) + end
            for at in range(0, len(ids), step):
                part = ids[at : at + step]
                yield doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part if seen % every == 0 and len(part) < step else None
            seen += 1

    def cut(batches):
        seen = 0
        try:
            for batch in batches:
                got = list(zip(*rows(batch, seen), strict=True))
                seen += batch.num_rows
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(got, types, strict=True)], names)
        finally:
            encoder(path).forget()

    return docs.mapInArrow(cut, PIECES)


def packed_group(group: int, t: pa.Table, capacity: int = CAPACITY) -> pa.Table:
    """PACKED rows of a group's PIECES."""
    ids = t.column("ids").to_pylist()
    whole = np.array([k for k, x in enumerate(ids) if x is None], np.int64)
    spare = np.array([k for k, x in enumerate(ids) if x is not None], np.int64)
    doc_id, (start, length, crc, tokens) = t.column("doc_id").combine_chunks(), (t.column(c).to_numpy() for c in ("start", "length", "ids_crc32", "doc_tokens"))
    bins, offsets, used = first_fit_decreasing(length[whole], capacity)
    parts = list(filled(used, length[spare].tolist(), capacity))
    cut = np.array(parts, np.int64).reshape(-1, len(Part._fields))
    of = spare[cut[:, 0]]
    sums = [zlib.crc32(ids[spare[p.row]][4 * p.start : 4 * (p.start + p.length)]) for p in parts]
    rows = np.r_[whole, of]
    arrays = [np.r_[start[whole], start[of] + cut[:, 1]], np.r_[length[whole], cut[:, 2]], np.r_[crc[whole], np.array(sums, np.int64)], tokens[rows], (group << 32) + np.r_[bins, cut[:, 3]], np.r_[offsets, cut[:, 4]]]
    return pa.table([doc_id.take(pa.array(rows)), *map(pa.array, arrays)], [c.split()[0] for c in PACKED.split(", ")])


def packed_in_groups(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, size: int = GROUP) -> DataFrame:
    """PACKED rows of all documents (doc_id, text): each id lies in one piece, each piece in one sequence of at most `capacity` ids.

    Pieces are dealt to groups of about `size` by a hash of their row, whatever their documents are, so copies and long
    documents are no hot groups. Within a group, pieces of documents that aren't fillers are placed by first-fit decreasing, and fillers are
    cut to fill the rest: only gaps below LEAST, or beyond what the fillers hold, need padding. sequence_id is the group's number and
    that of its sequence.

    Null texts count as empty (one id); null doc_ids are packed like others; repeated rows are packed as often as they occur; an
    empty table gives no rows. Other columns are ignored. The pieces are written once, so that retries deal them out alike.
    """
    cut = written(token_pieces(docs, path or vocabulary(VOCABULARY), capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-cut.count() // size))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("row", F.lit(12)), F.lit(groups)).cast("long")).drop("row")

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        return packed_group(key[0].as_py(), t, capacity)

    return dealt.groupBy("group").applyInArrow(pack, PACKED)


def op12_grouped_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_in_groups(documents(spark, sf_dir))
