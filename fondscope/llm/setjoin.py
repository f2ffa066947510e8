"""Parts that the exact similarity joins over five-word shingle sets share.

Two sets are linked when 100 * |A & B| >= 75 * |A | B|. `promising` finds, by one counted exchange and without false
dismissals, the sets that can have a partner at all; `prefixes` orders the shingles of those by rarity and keeps
the positions at which a first common shingle must lie; `linked` verifies pairs exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import bounded_broadcast, partitions, salted_join, written

PERCENT = 75
#: Entries that a task gathers before it sends them; memory is about 100 bytes for each.
FLUSH = 1 << 19
#: Entries that one part of the counted exchange takes on average (about 60 bytes each in its task).
PART = 1 << 22
_U = np.uint64


def least_common(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of n must share with any partner."""
    return (PERCENT * n + 99) // 100


def needed(n: np.ndarray) -> np.ndarray:
    """How many of a set's `filter_length` lowest hashes must occur in another set."""
    return np.minimum(n // 8 + 1, least_common(n))


def filter_length(n: np.ndarray) -> np.ndarray:
    """Of the lowest hashes of a set of n, at least `needed` of this many are among those of any partner.

    The first `needed` common hashes of two sets lie among the n - common + needed lowest of either; one more makes
    up for the rounding between sets of different sizes.
    """
    return np.minimum(n, n - least_common(n) + needed(n) + 1)


def set_key(rec: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64 bits for each record's set of shingles, whatever their order; 0 where it is empty."""
    total = np.r_[_U(0), np.cumsum(words.mixed(h + _U(0x9E3779B97F4A7C15)))]
    end = np.cumsum(n)
    key = words.mixed((total[end] - total[end - n]) + n.astype(_U) * _U(0xD6E8FEB86659FD93)) | _U(4)
    return np.where(n > 0, key, _U(0))


#: Yields, for slices of a batch: record's place in the batch of the slice's first record, then distinct_shingles().
Sets = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def of_texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    data, at = words.bytes_of(batch.column("text"))
    for s in words.slices(data, at):
        yield words.distinct_shingles(s)


def _sent(tag: np.ndarray, h: np.ndarray, parts: int, turn: int) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
    """What a task sends of its entries, by part of the hash: each hash once, or twice under the tags 0 and 1 if two sets of
    this task have it. The sets that are known to share it are counted here (kind 1), so no part gathers a hot hash."""
    order = np.lexsort((tag, h))
    tag, h = tag[order], h[order]
    keep = np.r_[True, (h[1:] != h[:-1]) | (tag[1:] != tag[:-1])]
    tag, h = tag[keep], h[keep]
    first = np.r_[True, h[1:] != h[:-1]]
    run = np.cumsum(first) - 1
    many = np.bincount(run)[run] > 1
    if many.any():
        who, times = np.unique(tag[many], return_counts=True)
        yield turn % parts, 1, who.tobytes(), times.astype(np.uint32).tobytes(), b""
        hot = h[many & first]
        tag = np.r_[tag[~many], np.zeros(len(hot), _U), np.ones(len(hot), _U)]
        h = np.r_[h[~many], hot, hot]
    part = ((h >> _U(words.HASH_BITS - 24)) * _U(parts)) >> _U(24)
    order = np.lexsort((h, tag, part))
    tag, h, part = tag[order], h[order], part[order]
    cut = np.searchsorted(part, np.arange(parts + 1))
    for p in range(parts):
        t, x = tag[cut[p] : cut[p + 1]], h[cut[p] : cut[p + 1]]
        if len(t):
            at = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            yield p, 0, t[at].tobytes(), np.diff(np.r_[at, len(t)]).astype(np.uint32).tobytes(), (x & _U(0xFFFFFFFF)).astype(np.uint32).tobytes()


_SENT = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("tags", pa.binary()), ("times", pa.binary()), ("hashes", pa.binary())])


def entries(sizes: DataFrame, n: str = "n") -> int:
    """How many hashes `promising` sends at most for sets of these sizes, counted where the sizes already lie."""
    n = F.col(n).cast("long")
    return sizes.agg(F.sum(F.least(n, n - F.floor((PERCENT * n + 99) / 100) + F.floor(n / 8) + 2))).first()[0] or 0


def promising(df: DataFrame, sets: Sets, total_entries: int) -> DataFrame:
    """(key, shared): for the sets of `df` that share some of their lowest hashes with another set, how many of those.

    Only sets with shared >= needed(n) can have a partner. Entries travel packed: 4 bytes a hash beside each set's key. A task
    of the exchange holds the entries of its part, so the number of parts follows `total_entries`, whatever the session's setting.
    """
    parts = max(partitions(df.sparkSession), -(-total_entries // PART))

    def send(batches):
        kept, size, turn = [], 0, 0

        def flush():
            tag, h = (np.concatenate(x) for x in zip(*kept, strict=True))
            rows = list(_sent(tag, h, parts, turn))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SENT.types, strict=True)], schema=_SENT)

        for batch in batches:
            for rec, h, n in sets(batch):
                place = np.arange(len(rec)) - np.repeat(np.cumsum(n) - n, n)
                low = place < filter_length(n)[rec]
                key = set_key(rec, h, n)
                kept.append((key[rec[low]], h[low]))
                size += int(low.sum())
                if size >= FLUSH:
                    yield flush()
                    kept, size, turn = [], 0, turn + 1
        if size:
            yield flush()

    def count(batches):
        tags, hashes, known = [], [], []
        for batch in batches:
            for kind, t, times, x in zip(batch.column("kind").to_pylist(), batch.column("tags"), batch.column("times"), batch.column("hashes"), strict=True):
                t, times = np.frombuffer(t.as_buffer(), _U), np.frombuffer(times.as_buffer(), np.uint32)
                if kind:
                    known.append((t, times.astype(np.int64)))
                else:
                    tags.append(np.repeat(t, times))
                    hashes.append(np.frombuffer(x.as_buffer(), np.uint32))
        if tags:
            tag, h = np.concatenate(tags), np.concatenate(hashes)
            order = np.lexsort((tag, h))
            tag, h = tag[order], h[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (tag[1:] != tag[:-1])]
            tag, h = tag[new], h[new]
            run = np.cumsum(np.r_[True, h[1:] != h[:-1]]) - 1
            tag = tag[np.bincount(run)[run] > 1]
            known.append((tag, np.ones(len(tag), np.int64)))
        if known:
            who, total = summed(known)
            real = who > 3
            yield from dealt_out(who[real], total[real])

    def summed(known):
        tag, times = (np.concatenate(x) for x in zip(*known, strict=True))
        who, at = np.unique(tag, return_inverse=True)
        return who, np.bincount(at, times).astype(np.int64)

    def dealt_out(who, total):
        """Sums of one task, packed by part of the key: a row for each part, not for each key."""
        part = (words.mixed(who) % _U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        who, total, cut = who[order], total[order], np.searchsorted(part[order], np.arange(parts + 1))
        some = [p for p in range(parts) if cut[p + 1] > cut[p]]
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array([x[cut[p] : cut[p + 1]].tobytes() for p in some], pa.binary()) for x in (who, total))], ["part", "tags", "times"])

    def total(batches):
        known = [(np.frombuffer(t.as_buffer(), _U), np.frombuffer(n.as_buffer(), np.int64)) for batch in batches for t, n in zip(batch.column("tags"), batch.column("times"), strict=True)]
        if known:
            who, times = summed(known)
            yield pa.RecordBatch.from_arrays([pa.array(who.view(np.int64)), pa.array(times)], ["key", "shared"])

    def dealt(rows):
        return rows.repartitionById(parts, "part") if hasattr(rows, "repartitionById") else rows.repartition(parts, "part")

    sent = df.mapInArrow(send, "part int, kind int, tags binary, times binary, hashes binary")
    counted = dealt(sent).mapInArrow(count, "part int, tags binary, times binary")
    return dealt(counted).mapInArrow(total, "key long, shared long")


def first_of_lists(lists: DataFrame, first: Column) -> DataFrame:
    """`lists` with the row of each list (of one hash) that is least by `first`, and then by its other columns, as `head`."""
    heads = lists.groupBy("hash").agg(F.min(F.struct(first.alias("rank"), *(F.col(c) for c in lists.columns if c != "hash"))).alias("head"))
    return salted_join(lists, heads, ["hash"], ["id"], lists.groupBy("hash").agg(F.count("*").alias("times")), lists.count())


def can_link(n: str = "n", shared: str = "shared"):
    """needed(), as a column."""
    n = F.col(n)
    return F.col(shared) >= F.least(F.floor(n / 8) + 1, F.floor((PERCENT * n + 99) / 100))


def prefixes(sets: DataFrame) -> DataFrame:
    """(hash, id, n, pos): of the sets (id, n, hashes), the shingles at which a first common one must lie, rarest first.

    A shingle of only one set can't be common: it takes a position but gives no row, so most sets give none.
    """
    each = sets.select("id", "n", F.explode("hashes").alias("hash"))
    counts = each.groupBy("hash").count().filter("count > 1")
    common = each.join(counts, "hash").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("count", "hash"))).alias("xs"))
    length = F.col("n") - F.floor((PERCENT * F.col("n") + 99) / 100) + 1
    common = common.withColumn("alone", F.col("n") - F.size("xs")).withColumn("take", F.greatest(F.lit(0), length - F.col("alone")).cast("int"))
    rows = common.filter("take > 0").select("id", "n", "alone", F.posexplode(F.slice("xs", F.lit(1), F.col("take"))).alias("k", "x"))
    return rows.select(F.col("x.hash").alias("hash"), "id", "n", (F.col("alone") + F.col("k")).cast("int").alias("pos"))


def may_reach(n_a, pos_a, n_b, pos_b):
    """Length and positional filter: whether two sets whose first common shingle lies at these positions can be linked."""
    most = 1 + F.least(n_a - pos_a, n_b - pos_b) - 1
    return (100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)) & ((100 + PERCENT) * most >= PERCENT * (n_a + n_b))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, each verified on its whole sets. A set of very many pairs is sent to
    several tasks."""
    one = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("s_a"))
    two = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("s_b"))
    pairs = written(pairs.select("a", "b"), "pairs")
    total, often = pairs.count(), lambda end: pairs.groupBy(end).agg(F.count("*").alias("times"))
    both = salted_join(salted_join(pairs, one, ["a"], ["b"], often("a"), total), two, ["b"], ["a"], often("b"), total)
    same = F.size(F.array_intersect("s_a", "s_b"))
    return both.filter(100 * same >= PERCENT * (F.col("n_a") + F.col("n_b") - same)).select("a", "b").distinct()


def semi(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of `df` whose `on` is in `ids`; the ids are broadcast only if counted and small."""
    return df.join(bounded_broadcast(ids.select(on).distinct(), 16), on, "left_semi")


__all__ = ["PERCENT", "can_link", "entries", "filter_length", "first_of_lists", "least_common", "linked", "may_reach", "needed", "of_texts", "prefixes", "promising", "semi", "set_key", "written"]
