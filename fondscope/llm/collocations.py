"""Operator 13: phrases whose words occur together more often than apart, by top-order marginalisation.

Only the longest windows are counted: each word with the LONGEST - 1 words that follow it in its piece, padded at the piece's end. The
lead columns are the word array shifted within the task that has read the text, so no word is shuffled to find its neighbour.
ROLLUP over (lang, w1, ..., w4) then gives every shorter phrase's count as the sum of the windows that begin with it, and the
count of all words of a language.

A phrase can't be more frequent than its parts, so a window may end early where a word, pair or triple in it is too rare, and the rare
windows, which are nearly all different, collapse. Which of these are frequent is told by bitmaps over hashes, of bounded size,
that let too much through but never too little: phrases' counts come from the windows alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, small_batches, text_or_empty, written
from .words import _hashed, bytes_of, lowered, mixed

LONGEST, LEAST, TOP = 4, 30, 2000
#: A longer phrase of so many hundredths of a candidate's count stands for it.
COVERED = 80
SCALE = 2_000_000
#: Bytes of text cut into words at once; words of which a task counts pairs or windows before it hands them on.
BLOCK, HELD = 1 << 18, 1 << 17
#: Bits of a filter: so many for each frequent key, within these bounds (32 MB at most). Where the upper one is reached, it
#: prunes less, and the result is the same.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 28
_BITMAP = 1 << 15
_U = np.uint64
_PAIR = _U(0xE7037ED1A0B428DB)
#: 1: between words; 2: between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x09, 0x20]] = 1
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
#: Filters of words, pairs and triples, or the first of these.
Filters = Sequence[np.ndarray]
WINDOW = [f"w{k + 1}" for k in range(LONGEST)]


class Block(NamedTuple):
    """Words in order: hashes, number of their piece, and number of their language; and their first and last bytes in `data`."""

    hashes: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray


class Langs:
    """Languages of a task by number, and what their names add to the hashes of their words."""

    def __init__(self, salt: int):
        self.salt, self.number, self.names, self.marks = salt, {}, [], np.zeros(0, _U)

    def of(self, column: list[str]) -> np.ndarray:
        for name in dict.fromkeys(column):
            if name not in self.number:
                self.number[name] = len(self.names)
                self.names.append(name)
                self.marks = np.append(self.marks, _U(xxhash.xxh64_intdigest(name.encode(), self.salt)))
        return np.array([self.number[x] for x in column], np.int32)

    def column(self, of: np.ndarray) -> pa.Array:
        return pa.array(self.names, pa.string()).take(pa.array(of))


def blocks(batch: pa.RecordBatch, langs: Langs, piece: int = 0) -> Iterator[Block]:
    """The words of a batch (text, lang), some at a time. Blocks end between words, and a piece may go on in the next."""
    data, at = bytes_of(batch.column(0))
    of = langs.of(batch.column(1).to_pylist())
    a, z = int(at[0]), int(at[-1])
    while a < z:
        e = min(z, a + BLOCK)
        while e < z and not _CLASS[data[e]]:
            more = np.flatnonzero(_CLASS[data[e : e + BLOCK]])
            e = min(z, e + (int(more[0]) if len(more) else BLOCK))
        b = lowered(data[a:e])
        kind = _CLASS[b]
        cuts = at[np.searchsorted(at, a) : np.searchsorted(at, e)] - a  # first bytes of texts
        ends = kind == 2
        ends[cuts] = True
        word = kind == 0
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        begins[cuts] = word[cuts]
        stops = word.copy()
        stops[:-1] &= ~word[1:]
        before = cuts[cuts > 0] - 1
        stops[before] = word[before]
        start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        upto = np.cumsum(ends)
        lang = of[np.searchsorted(at, start + a, "right") - 1]
        hashes = mixed(_hashed(b, start, end - start) ^ langs.marks[lang])
        yield Block(np.maximum(hashes, _U(1)), piece + upto[start], lang, start, end, b)
        piece, a = piece + int(upto[-1]), e


def has(filter: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    """Whether a filter lets the keys through; no filter lets all through."""
    if filter is None:
        return np.ones(len(keys), bool)
    place = keys & _U(8 * len(filter) - 1)
    return (filter[(place >> _U(3)).astype(np.int64)] >> (place & _U(7)).astype(np.uint8)) & 1 == 1


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a + mixed(b) * _PAIR)


def passing(h: np.ndarray, piece: np.ndarray, filters: Filters, longest: int = LONGEST) -> tuple[list[np.ndarray], np.ndarray]:
    """For 1 to `longest` words, whether so many from each place on lie in one piece and pass the filters (of words, of pairs, and so on; what
    has none passes if its parts do); and the keys of the longest."""
    key, on = h, has(filters[0] if filters else None, h)
    out = [on]
    for m in range(2, longest + 1):
        on = on[:-1] & on[1:]
        if m == 2:
            on &= piece[:-1] == piece[1:]
        key = pair_keys(key[:-1], h[m - 1 :])
        if m <= len(filters):
            on[on] = has(filters[m - 1], key[on])
        out.append(on)
    return out, key


def windows(h: np.ndarray, piece: np.ndarray, filters: Filters) -> np.ndarray:
    """For each word the window that begins with it, a row of LONGEST hashes; 0 pads it from the piece's end on, or from where words, pairs or
    triples are too rare."""
    out = np.zeros((len(h), LONGEST), _U)
    for k, on in enumerate(passing(h, piece, filters)[0]):
        out[: len(on), k] = np.where(on, h[k:], 0)
    return out


def distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows, one of each different row of the columns (nearly: a row may come twice), and how often each occurs."""
    key = columns[0].astype(_U)
    for c in columns[1:]:
        key = pair_keys(key, c.astype(_U))
    order = np.argsort(key, kind="stable")
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for c in columns:
        x = c[order]
        fresh[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(fresh)
    return order[first], np.diff(np.r_[first, len(order)])


def _words_of(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    langs = Langs(salt)
    for batch in batches:
        for b in blocks(batch, langs):
            _, at, n = np.unique(b.hashes, return_index=True, return_counts=True)
            raw = b.data.tobytes()
            text = pa.array([raw[s:e] for s, e in zip(b.start[at].tolist(), b.end[at].tolist(), strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([langs.column(b.lang[at]), pa.array(b.hashes[at].view(np.int64)), text, pa.array(n.astype(np.int64))], ["lang", "h", "word", "n"])


def _runs(batches: Iterator[pa.RecordBatch], langs: Langs) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Hashes, pieces and languages of about HELD words at a time, and how many of them are new: the rest only follow these, and come
    again. All a task's batches are one run of pieces."""
    held, size, piece = [], 0, 0
    for batch in batches:
        for b in blocks(batch, langs, piece):
            held.append((b.hashes, b.piece, b.lang))
            size += len(b.hashes)
            piece = int(b.piece[-1]) if len(b.piece) else piece
            if size >= HELD:
                h, p, g = (np.concatenate(x) for x in zip(*held, strict=True))
                new = len(h) - (LONGEST - 1)
                yield h, p, g, new
                held, size = [(h[new:], p[new:], g[new:])], LONGEST - 1
        piece += 1  # the next batch begins with another text
    if size:
        h, p, g = (np.concatenate(x) for x in zip(*held, strict=True))
        yield h, p, g, len(h)


def _grams_of(batches: Iterator[pa.RecordBatch], salt: int, *filters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Keys of all runs of one word more than there are filters, whose parts pass these, and their counts so far."""
    m = len(filters) + 1
    for h, piece, _, new in _runs(batches, Langs(salt)):
        on, key = passing(h[: new + m - 1], piece[: new + m - 1], filters, m)
        keys, n = np.unique(key[on[-1]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])


def _windows_of(batches: Iterator[pa.RecordBatch], salt: int, *filters: np.ndarray) -> Iterator[pa.RecordBatch]:
    langs = Langs(salt)
    for h, piece, lang, new in _runs(batches, langs):
        w = windows(h, piece, filters)[:new]
        rows, n = distinct([lang[:new], *w.T])
        yield pa.RecordBatch.from_arrays([langs.column(lang[rows]), *(pa.array(w[rows, k].view(np.int64)) for k in range(LONGEST)), pa.array(n.astype(np.int64))], ["lang", *WINDOW, "n"])


def bitmap(keys: DataFrame) -> np.ndarray:
    """A filter of the keys (h). Spark builds it in parts of 4 KB; only it reaches the driver, at most MOST_BITS of it."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * keys.count()).bit_length()))
    place = F.col("h").bitwiseAND(bits - 1)
    parts = keys.select(F.shiftright(place, 15).alias("part"), place.bitwiseAND(_BITMAP - 1).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.collect():
        out[r.part * (_BITMAP // 8) : (r.part + 1) * (_BITMAP // 8)] = np.frombuffer(r.bits, np.uint8)
    return out


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, w, f) of all phrases of 1 to LONGEST words with f >= least, `w` an array of word hashes, and of no words: all words of a
    language; and (lang, h, word) of the frequent words.

    Words are told apart by 64-bit hashes; where two frequent ones of a language are found to have the same, all is hashed anew
    with another salt, so the counts are exact.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(text_or_empty().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    salt, words = 0, None
    while words is None or not words.filter("clash").isEmpty():
        salt += 1
        each = texts.mapInArrow(_bound(_words_of, salt), "lang string, h long, word string, n long")
        total = each.groupBy("lang", "h").agg(F.sum("n").alias("n"), F.min("word").alias("word"), (F.min("word") != F.max("word")).alias("clash"))
        words = written(total.filter(F.col("n") >= least), "words")
    filters = [spark.sparkContext.broadcast(bitmap(words.select("h")))]
    for m in range(2, LONGEST):
        grams = texts.mapInArrow(_bound(_grams_of, salt, *filters), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
        filters.append(spark.sparkContext.broadcast(bitmap(written(grams.filter(F.col("n") >= least).select("h"), f"grams-{m}"))))
    longest = texts.mapInArrow(_bound(_windows_of, salt, *filters), f"lang string, {', '.join(f'{c} long' for c in WINDOW)}, n long")
    rolled = longest.rollup("lang", *WINDOW).agg(F.sum("n").alias("f"))
    rolled = rolled.filter(F.col("lang").isNotNull() & (F.coalesce(*reversed(WINDOW), F.lit(1)) != 0))  # prefixes that end in padding: Catalyst drops them before they are counted
    phrases = rolled.select("lang", F.array_compact(F.array(*WINDOW)).alias("w"), "f")
    kept = (F.size("w") == 0) | (F.col("f") >= least)
    return written(phrases.filter(kept), "phrases"), words.select("lang", "h", "word")


def _bound(f: Callable, *args) -> Callable:
    """`f` over a task's batches, with arguments of which broadcast ones are taken where the task runs."""

    def run(batches):
        yield from f(batches, *(a.value if hasattr(a, "value") else a for a in args))

    return run


def _exact(c: str, factor: int) -> Column:
    """A product that may pass 64 bits."""
    return F.lit(factor).cast("decimal(10,0)") * F.col(c).cast("decimal(19,0)")


def uncovered(phrases: DataFrame, covered: int = COVERED) -> DataFrame:
    """(lang, w, f) of the candidates, phrases of two words or more, that no longer one stands for: none that holds their words in a row
    has `covered` hundredths of their count."""
    found = phrases.filter(F.size("w") >= 2)
    parts = F.expr("flatten(transform(sequence(2, size(w) - 1), n -> transform(sequence(1, size(w) - n + 1), at -> slice(w, at, n))))")
    longer = found.filter(F.size("w") >= 3).select("lang", F.explode(parts).alias("w"), "f").groupBy("lang", "w").agg(F.max("f").alias("longer"))
    return found.join(longer, ["lang", "w"], "left").filter(F.col("longer").isNull() | (_exact("longer", 100) < _exact("f", covered))).drop("longer")


def scored(found: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, w, a, l, r, score) of phrases `found` by their weakest cut; of equally weak ones the first."""
    cuts = found.select("lang", "w", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.withColumn("left", F.expr("slice(w, 1, k)")).withColumn("right", F.expr("slice(w, k + 1, size(w) - k)"))
    counts = phrases.filter(F.size("w") < LONGEST)
    for part, to in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("w").alias(part), F.col("f").alias(to)), ["lang", part])
    cuts = cuts.withColumn("scaled", _exact("a", SCALE)).withColumn("score", F.expr("scaled div (cast(l as decimal(19,0)) + r)").cast("long"))
    best = cuts.groupBy("lang", "w", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "w", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language of `docs` (text, lang).

    Texts are lower-cased (A-Z), cut into pieces at `. , ; : ! ?` and line ends, and these into words at blanks and tabs. Null
    texts are empty; a null lang is `und`; repeated rows count as often as they occur; without any frequent phrase there are no rows.
    Other columns are ignored.
    """
    phrases, words = phrase_counts(docs, least)
    found = scored(uncovered(phrases, covered), phrases)
    order = [F.desc("score"), F.desc("a")]
    by = Window.partitionBy("lang")
    first = found.withColumn("at", F.rank().over(by.orderBy(*order))).filter(F.col("at") <= top).drop("at")  # with all ties of the last
    spelt = first.select("*", F.posexplode("w").alias("k", "h")).join(words, ["lang", "h"])
    spelt = spelt.groupBy("lang", "w", "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("k", "word"))).alias("parts"))
    spelt = spelt.withColumn("phrase", F.array_join(F.transform("parts", lambda p: p["word"]), " "))
    ranked = spelt.withColumn("rank", F.row_number().over(by.orderBy(*order, "phrase")).cast("long")).filter(F.col("rank") <= top)
    totals = phrases.filter(F.size("w") == 0).select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))
