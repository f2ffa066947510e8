"""Operator 1: passages of a benchmark in documents. SimHash of item-sized windows, looked up through a multi-index of
Hamming blocks; exact weighted-shingle similarity verifies."""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import documents, small_batches, text_or_empty, written

BITS, RADIUS = 64, 20
PERCENT = 75
#: Bytes of item texts that one pass over the documents holds; more items take more passes.
PASS_BYTES = 16 << 20
FILTER_BITS = 22
_U = np.uint64


class Item(NamedTuple):
    item_id: int
    words: int
    weights: dict[int, int]  # of its shingles: how often each occurs
    print: int


def votes(h: np.ndarray) -> np.ndarray:
    """Of each word hash, +1 or -1 for every bit."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def fingerprint(total: np.ndarray) -> np.ndarray:
    """64 bits from rows of summed votes."""
    return np.packbits(total > 0, axis=-1, bitorder="little").view(_U).ravel()


def blocks() -> list[tuple[int, int]]:
    """RADIUS + 1 blocks of bits (shift, width): two fingerprints within RADIUS agree in one of them at least."""
    cut = [round(k * BITS / (RADIUS + 1)) for k in range(RADIUS + 2)]
    return [(a, b - a) for a, b in zip(cut, cut[1:], strict=False)]


def items_of(rows: list[tuple[int, str]]) -> list[Item]:
    out = []
    for item_id, text in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        got = list(words.slices(data, np.array([0, len(data)])))
        if not got or not len(got[0].hashes):
            continue
        _, s = words.shingles(got[0])
        u, n = np.unique(s, return_counts=True)
        out.append(Item(item_id, len(got[0].hashes), dict(zip(u.tolist(), n.tolist(), strict=True)), int(fingerprint(votes(got[0].hashes).sum(0))[0])))
    return out


class Index:
    """Items by the values of their fingerprints' blocks, and by their shingles."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.blocks = blocks()
        self.table: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        self.with_shingle: dict[int, list[int]] = defaultdict(list)
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))  # by words and shingle
        for k, item in enumerate(items):
            if item.words < words.SHINGLE:
                self.short[item.words][next(iter(item.weights))].append(k)
                continue
            for b, (shift, width) in enumerate(self.blocks):
                self.table[item.words, b, item.print >> shift & (1 << width) - 1].append(k)
            for s in item.weights:
                self.with_shingle[s].append(k)
        self.shingles = np.array(sorted(self.with_shingle), _U)
        self.bits = np.zeros(1 << FILTER_BITS, bool)
        self.bits[(self.shingles >> _U(64 - FILTER_BITS)).astype(np.int64)] = True

    def equal(self, s: words.Slice) -> list[tuple[int, int, int, int]]:
        """(record, item, first word, words) where a record of the slice first has an item of fewer than five words."""
        first, out = np.cumsum(s.counts) - s.counts, {}
        for m, own in self.short.items():
            at, v = words.short_shingles(s, m)
            some = np.flatnonzero(np.isin(v, np.array(list(own), _U)))
            for a, x in zip(at[some].tolist(), v[some].tolist(), strict=True):
                r = int(np.searchsorted(first, a, "right")) - 1
                for k in own[x]:
                    out.setdefault((r, k), (a - int(first[r]), m))
        return [(r, k, a, m) for (r, k), (a, m) in sorted(out.items())]

    def hits(self, s: np.ndarray) -> np.ndarray:
        """Places of shingles that an item has."""
        maybe = np.flatnonzero(self.bits[(s >> _U(64 - FILTER_BITS)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.shingles, s[maybe]), len(self.shingles) - 1)
            maybe = maybe[self.shingles[at] == s[maybe]]
        return maybe

    def near(self, size: int, prints: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, item, distance) for the windows' fingerprints within RADIUS of an item of `size` words."""
        found = set()
        for b, (shift, width) in enumerate(self.blocks):
            value = (prints >> _U(shift)) & _U((1 << width) - 1)
            for v in np.unique(value).tolist():
                if own := self.table.get((size, b, v)):
                    found.update((w, k) for w in np.flatnonzero(value == _U(v)).tolist() for k in own)
        out = []
        for w, k in found:
            d = (int(prints[w]) ^ self.items[k].print).bit_count()
            if d <= RADIUS:
                out.append((w, k, d))
        return out


def similarity(one: dict[int, int], two: dict[int, int]) -> tuple[int, int]:
    """Sums of the smaller and of the greater weights of all shingles."""
    least = sum(min(n, two.get(s, 0)) for s, n in one.items())
    return least, sum(one.values()) + sum(two.values()) - least


def in_document(h: np.ndarray, s: np.ndarray, hits: np.ndarray, index: Index) -> list[tuple[int, int, int, int, float]]:
    """(item, first word, words, distance, similarity) of the best window for each item, from a document's word and shingle
    hashes. A window without any shingle of an item can't be similar to it, so windows start near a hit only. Items of fewer than
    five words aren't looked for here (see `Index.equal`)."""
    starts = defaultdict(set)
    for p in hits.tolist():
        for k in index.with_shingle[int(s[p])]:
            m = index.items[k].words
            starts[m].update(range(p - max(0, m - words.SHINGLE), p + 1))
    best: dict[int, tuple] = {}
    lo = max(0, min(map(min, starts.values())))
    hi = min(len(h), max(max(x) + m for m, x in starts.items()))
    total = np.zeros((hi - lo + 1, BITS), np.int32)
    np.cumsum(votes(h[lo:hi]), axis=0, out=total[1:])
    for m, x in starts.items():
        begin = np.array(sorted(x))
        a, e = np.maximum(begin, 0), np.minimum(begin + m, len(h))
        a, e = np.unique(np.stack([a[e > a], e[e > a]]), axis=1)
        for w, k, d in index.near(m, fingerprint(total[e - lo] - total[a - lo])):
            width = max(1, int(e[w] - a[w]) - words.SHINGLE + 1)
            u, n = np.unique(s[a[w] : a[w] + width], return_counts=True)
            least, most = similarity(dict(zip(u.tolist(), n.tolist(), strict=True)), index.items[k].weights)
            if 100 * least >= PERCENT * most:
                got = (-least / most, d, int(a[w]), int(e[w] - a[w]))
                best[k] = min(best.get(k, got), got)
    return [(k, a, n, d, -sim) for k, (sim, d, a, n) in best.items()]


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance, similarity): the best window of each document (doc_id, text) for each
    benchmark item (item_id, text) whose weighted five-word shingles are 0.75 or more similar.

    Words are runs other than 0x20 and 0x09-0x0D, A-Z lower-cased; a shingle weighs as often as it occurs. An item of fewer than
    five words is one shingle of its length, so its windows are equal to it or not similar at all. Windows have the
    item's number of words and are cut at the document's ends. Fingerprints (64 bits over the words) within RADIUS of an item's
    are all found. Null or empty texts and items match nothing; items of one id and text count once; rows with one doc_id
    each give their rows; ties take the smaller distance, then the earlier window. Other columns are ignored.
    The items go to the workers, PASS_BYTES of them at a time: more items take more passes, each of which is written before the next
    one begins, and not more memory.
    """
    return _versions(docs, benchmark).drop("version")


def _versions(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`passages` with a hash of the document's text in `version`."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _version(), text_or_empty().alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // PASS_BYTES))
    out = None
    for k in range(passes):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).orderBy("item_id", "text").collect()  # about PASS_BYTES
        found = docs.mapInArrow(_search([(r.item_id, r.text) for r in rows]), _SCHEMA)
        found = found if passes == 1 else written(found, "passages")
        out = found if out is None else out.union(found)
    return out


def _version():
    return F.xxhash64(text_or_empty()).alias("version")


_SCHEMA = "doc_id long, version long, item_id long, first_word long, n_words long, distance int, similarity double"


def _search(rows: list[tuple[int, str]]):
    def search(batches):
        index = Index(items_of(rows))
        for batch in batches:
            ids, versions, out = batch.column("doc_id"), batch.column("version"), []
            data, at = words.bytes_of(batch.column("text"))
            for s in words.slices(data, at) if index.items else ():
                for r, k, first, n in index.equal(s):
                    out.append((ids[s.first + r].as_py(), versions[s.first + r].as_py(), index.items[k].item_id, first, n, 0, 1.0))
                rec, v = words.shingles(s)
                hits = index.hits(v)
                if not len(hits):
                    continue
                word_at, shingle_at = np.cumsum(s.counts) - s.counts, np.searchsorted(rec, np.arange(len(s.counts) + 1))
                for r in np.unique(rec[hits]).tolist():
                    a, z = shingle_at[r], shingle_at[r + 1]
                    mine = hits[(hits >= a) & (hits < z)] - a
                    doc_id, version = ids[s.first + r].as_py(), versions[s.first + r].as_py()
                    for k, first, n, d, sim in in_document(s.hashes[word_at[r] : word_at[r] + s.counts[r]], v[a:z], mine, index):
                        out.append((doc_id, version, index.items[k].item_id, first, n, d, sim))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64()), strict=True)], ["doc_id", "version", "item_id", "first_word", "n_words", "distance", "similarity"])

    return search


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the documents that hold a passage of the benchmark. Rows go by doc_id and text: a null doc_id is one like
    others, and a clean row stays where another one with its doc_id goes."""
    found = _versions(docs, benchmark).select(F.col("doc_id").alias("decontamination doc"), F.col("version").alias("decontamination version")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("`decontamination doc`")) & (_version() == F.col("`decontamination version`"))
    return docs.join(found, same, "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
