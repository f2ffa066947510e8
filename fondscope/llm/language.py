"""Operator 8: language of whole texts, family first, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, small_batches

UNKNOWN = "und"
#: Training draws at most this many texts of a language, of each at most so many first characters. Of more than TEXTS /
#: PER_LANGUAGE languages it draws fewer texts each, TEXTS in all, but for the FEWEST that each language has at least.
PER_LANGUAGE, LONGEST, TEXTS, FEWEST = 400, 8192, 40_000, 25
#: Buckets for letters, pairs and triples; characters that are scored at a time.
BUCKETS, STEP = 1 << 12, 1 << 17
#: Shares of the training table that are multiplied at a time.
TABLE_BLOCK = 1 << 20
ORDERS = 3
#: Places in a piece of a text that is judged as one, at least and usually; labelled pieces that a language's bound needs.
SHORT_PIECE, PIECE, ENOUGH = 16, 64, 32

# Families of language codes; a code that isn't listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ast", "ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro", "sc"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu", "se"),
    "indic": ("as", "bn", "gu", "hi", "mr", "ne", "or", "pa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tk", "tr", "tt", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
}
# End of the fixed values.
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
_letters: list[np.ndarray] = []


class Model(NamedTuple):
    """weights: a column for each binary machine; families: of the first machines; pairs: (i, j) languages of the others.
    usual: a row of log chances of triples for each language; middle, spread: of a place in its pieces; bound: least usual standing."""

    languages: list[str]
    families: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray
    usual: np.ndarray
    middle: np.ndarray
    spread: np.ndarray
    bound: float


def family(code: str) -> str:
    return _FAMILY.get(code.lower().split("-")[0].split("_")[0], code)


def is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, other characters than letters as spaces, and three spaces more."""
    c = np.frombuffer((text.lower() + "   ").encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(is_letter()[np.minimum(c, 0x10FFFF)], c, np.uint32(32))


def buckets(c: np.ndarray) -> list[np.ndarray]:
    """Bucket of the letter, pair and triple that begins at each place but the last two."""
    n, x = len(c) - 2, c.astype(np.uint32)
    h, out = np.zeros(n, np.uint32), []
    for k in range(ORDERS):
        h = (h + x[k : k + n] + np.uint32(k + 1)) * np.uint32(0x9E3779B1)
        out.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(20)).astype(np.int64) + k * BUCKETS)
    return out


class Table:
    """Shares of buckets in texts, only those that aren't 0, and products with the standardized table (each bucket less its mean,
    times its scale), some rows at a time."""

    def __init__(self, sizes: np.ndarray, bucket: np.ndarray, value: np.ndarray, mean: np.ndarray | None = None, scale: np.ndarray | None = None):
        self.at = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        self.bucket, self.value = bucket, value
        d, n = ORDERS * BUCKETS, max(1, len(sizes))
        if mean is None:
            mean = np.bincount(bucket, value, d) / n
            square = np.bincount(bucket, np.square(value, dtype=float), d) / n
            scale = 1 / (np.sqrt(np.maximum(0, square - mean * mean)) + 1e-4) / np.sqrt(d)
        self.mean, self.scale = mean, scale

    @classmethod
    def of(cls, texts: list[str]) -> Table:
        got = []
        for text in texts:
            c = codes(text)
            u, n = np.unique(np.concatenate(buckets(c)), return_counts=True)
            got.append((u.astype(np.uint16), (n / (len(c) - 2)).astype(np.float32)))
        empty = (np.zeros(0, np.uint16), np.zeros(0, np.float32))
        bucket, value = (np.concatenate(x) for x in zip(empty, *got, strict=True))
        return cls(np.array([len(u) for u, _ in got], int), bucket, value)

    def rows(self, some: np.ndarray) -> Table:
        parts = [slice(self.at[i], self.at[i + 1]) for i in some]
        return Table(np.diff(self.at)[some], np.concatenate([self.bucket[x] for x in parts]), np.concatenate([self.value[x] for x in parts]), self.mean, self.scale)

    def blocks(self):
        i, n = 0, len(self.at) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.at, self.at[i] + TABLE_BLOCK, "right")) - 1)
            yield i, j, slice(self.at[i], self.at[j])
            i = j

    def sums(self, v: np.ndarray, square: bool = False) -> np.ndarray:
        """Of each row, the sum of its shares (or their squares) times `v`."""
        out = np.zeros(len(self.at) - 1)
        for i, j, x in self.blocks():
            value = np.square(self.value[x], dtype=float) if square else self.value[x]
            out[i:j] = np.add.reduceat(value * v[self.bucket[x]], self.at[i:j] - self.at[i])
        return out

    def times(self, v: np.ndarray) -> np.ndarray:
        v = self.scale * v
        return self.sums(v) - self.mean @ v

    def turned(self, g: np.ndarray) -> np.ndarray:
        """`g` times the table."""
        total = np.zeros(len(self.mean))
        for i, j, x in self.blocks():
            total += np.bincount(self.bucket[x], self.value[x] * np.repeat(g[i:j], np.diff(self.at[i : j + 1])), len(total))
        return (total - g.sum() * self.mean) * self.scale

    def norms(self) -> np.ndarray:
        """Squared lengths of the rows."""
        k = self.scale * self.scale
        return self.sums(k, square=True) - 2 * self.sums(self.mean * k) + self.mean @ (self.mean * k)


def triples(text: str) -> np.ndarray:
    """Bucket of each triple that begins with a letter; what lies between two words counts as one space."""
    c = codes(text)
    c = np.r_[c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]], np.uint32(32), np.uint32(32)]
    return buckets(c)[-1][c[:-2] != 32] - (ORDERS - 1) * BUCKETS


def log_chances(count: np.ndarray) -> np.ndarray:
    return np.log((count + 0.1) / (count.sum() + 0.1 * len(count))).astype(np.float32)


def pieces(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and length of the pieces of a text's values: four at least where they reach SHORT_PIECE, of PIECE or more in long texts."""
    n = len(value)
    k = max(1, min(n // SHORT_PIECE, 4), n // PIECE)
    at = np.arange(k) * n // k
    size = np.diff(np.r_[at, n])
    return np.add.reduceat(value, at) / size, size


def deviation(x: np.ndarray) -> float:
    return 1.4826 * float(np.median(np.abs(x - np.median(x))))


def usual(texts: list[str], label: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Each language's log chances of triples, the middle and spread of its labelled pieces, and the bound below which a piece
    is an outlier: three interquartile ranges below the lower quartile of all labelled pieces. Pieces are measured by the other
    half of their language's texts. A language with one text or fewer than ENOUGH pieces is measured by itself and has the
    widest spread of the others, so that its labelled texts are usual, and gibberish is not; where there are no others, spreads are infinite."""
    chances, middle, spread, standings = np.zeros((languages, BUCKETS), np.float32), np.zeros(languages), np.full(languages, np.inf), []
    rare: dict[int, np.ndarray] = {}
    for k in range(languages):
        mine = [t for t in (triples(texts[i]) for i in np.flatnonzero(label == k)) if len(t)]
        half = [sum((np.bincount(t, minlength=BUCKETS) for t in mine[f::2]), np.zeros(BUCKETS, int)) for f in (0, 1)]
        chances[k] = log_chances(half[0] + half[1])
        got = [pieces(log_chances(half[1 - f])[t]) for f in (0, 1) for t in mine[f::2]] if len(mine) > 1 else []
        if sum(len(n) for _, n in got) < ENOUGH:
            own = [pieces(chances[k][t])[0] for t in mine]
            rare |= {k: np.concatenate(own)} if own else {}
            continue
        value, n = (np.concatenate(x) for x in zip(*got, strict=True))
        middle[k] = np.median(value)
        spread[k] = max(0.1, deviation((value - middle[k]) * np.sqrt(n)))
        standings.append((value - middle[k]) * np.sqrt(n) / spread[k])
    if standings:
        widest = spread[np.isfinite(spread)].max()
        for k, value in rare.items():
            middle[k], spread[k] = np.median(value), widest
    q1, q3 = np.percentile(np.concatenate(standings), [25, 75]) if standings else (0.0, 0.0)
    return chances, middle, spread, float(q1 - 3 * (q3 - q1))


def is_usual(text: str, k: int, model: Model) -> bool:
    """Whether a quarter of the text's pieces or more aren't outliers of language k; other lines and codes may stand beside them."""
    fine = total = 0
    for a in range(0, len(text), STEP):
        t = triples(text[a : a + STEP])
        if len(t):
            value, n = pieces(model.usual[k][t])
            fine += int(((value - model.middle[k]) * np.sqrt(n) >= model.bound * model.spread[k]).sum())
            total += len(n)
    return 4 * fine >= total > 0


def machine(x: Table, y: np.ndarray, rounds: int = 150, c: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by accelerated gradient steps; classes weigh the same."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    step = 1.0 / (1e-3 + 2 * c * float((weight * (x.norms() + 1)).sum()))
    w = v = np.zeros(len(x.mean))
    b = bv = 0.0
    for t in range(rounds):
        gap = np.maximum(0, 1 - y * (x.times(v) + bv)) * weight * y
        nw, nb = v - step * (1e-3 * v - 2 * c * x.turned(gap)), bv + step * 2 * c * float(gap.sum())
        m = t / (t + 3)
        v, bv, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return w, b


def trained(texts: list[str], labels: list[str]) -> Model:
    languages = sorted(set(labels))
    d = ORDERS * BUCKETS
    x = Table.of(texts)
    label = np.array([languages.index(k) for k in labels], int)
    kin = np.array([family(k) for k in languages])
    families = sorted(set(kin)) if len(set(kin)) > 1 else []
    pairs = [(i, j) for i, j in combinations(range(len(languages)), 2) if kin[i] == kin[j]]
    w, bias, slope = [], [], []
    for k, f in enumerate([*families, *pairs]):
        if k == 1 and len(families) == 2:  # the mirror of the first
            w, bias, slope = [*w, -w[0]], [*bias, -bias[0]], [*slope, slope[0]]
            continue
        if isinstance(f, str):
            rows, y = np.arange(len(label)), np.where(kin[label] == f, 1.0, -1.0)
        else:
            rows = np.flatnonzero(np.isin(label, f))
            y = np.where(label[rows] == f[0], 1.0, -1.0)
        own = x if len(rows) == len(label) else x.rows(rows)
        v, b = machine(own, y)
        margin = float(np.median(np.abs(own.times(v) + b)))
        v = v * x.scale
        w.append(v)
        bias.append(b - float(x.mean @ v))
        slope.append(3.0 / max(margin, 1e-6))
    return Model(languages, families, pairs, np.stack(w, 1).astype(np.float32) if w else np.zeros((d, 0), np.float32), np.array(bias), np.array(slope), *usual(texts, label, len(languages)))


def margins(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Each text's margin by each machine, over all of its places; and which texts have a letter."""
    total, sizes, letters = np.zeros((len(texts), model.weights.shape[1])), np.zeros(len(texts)), np.zeros(len(texts), bool)
    batch, held = [], 0

    def settle():
        c = np.concatenate([x for _, x in batch])
        value = sum(model.weights[b] for b in buckets(c))
        ends = np.cumsum([len(x) for _, x in batch])
        edge = np.stack([ends - [len(x) for _, x in batch], ends - 2], 1).ravel()
        edge = edge[:-1] if edge[-1] >= len(value) else edge
        sums = np.add.reduceat(value, edge, axis=0)[::2]
        np.add.at(total, [i for i, _ in batch], sums)

    for i, text in enumerate(texts):
        c = codes(text)
        sizes[i], letters[i] = len(c) - 2, bool((c != 32).any())
        for a in range(0, len(c) - 2, STEP):
            batch.append((i, c[a : a + STEP + 2]))
            held += len(batch[-1][1])
            if held >= STEP:
                settle()
                batch, held = [], 0
    if batch:
        settle()
    return total / np.maximum(1, sizes)[:, None] + model.bias, letters


def predicted(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the chance of its family, times that of the closest comparison within it."""
    m, letters = margins([t or "" for t in texts], model)
    chance = 1 / (1 + np.exp(-np.clip(m * model.slope, -30, 30))) if len(model.slope) else m
    kin = [family(k) for k in model.languages]
    nf = len(model.families)
    out, score = [], np.zeros(len(texts))
    best = m[:, :nf].argmax(1) if nf else np.zeros(len(texts), int)
    members = {f: [i for i, k in enumerate(kin) if k == f] for f in set(kin)}
    names = model.families or ([kin[0]] if kin else [])
    for r in range(len(texts)):
        if not letters[r] or not names:
            out.append(UNKNOWN)
            continue
        mine = members[names[best[r]]]
        wins = dict.fromkeys(mine, 0)
        least = dict.fromkeys(mine, 1.0)
        for k, (i, j) in enumerate(model.pairs, nf):
            if i in wins:
                p = chance[r, k]
                wins[i if p >= 0.5 else j] += 1
                least[i], least[j] = min(least[i], p), min(least[j], 1 - p)
        top = max(mine, key=lambda i: (wins[i], least[i]))
        out.append(model.languages[top])
        score[r] = (chance[r, best[r]] if nf else 1.0) * least[top]
    return out, score


def per_language(languages: int) -> int:
    """How many texts of each of so many languages are learned from."""
    return min(PER_LANGUAGE, max(FEWEST, TEXTS // max(1, languages)))


def learned(docs: DataFrame, remainder: int = 1, divisor: int = 3) -> Model:
    """Fit on documents whose crc32(doc_id as text) mod `divisor` isn't `remainder`: at most PER_LANGUAGE texts of each
    language (by a hash of doc_id; of each its first LONGEST characters, if these have a letter) reach the driver, and about TEXTS
    in all: every language is learned, many of them from fewer texts each. Before they are ranked, each language's documents
    are thinned by the same hash to about four times as many as are wanted."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).filter(F.crc32(F.col("doc_id").cast("string")) % divisor != remainder)
    known = known.withColumn("text", F.substring(F.col("text").cast("string"), 1, LONGEST)).filter(F.col("text").rlike(r"\p{L}"))
    known = known.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language
    each = per_language(len(counts))
    often = F.broadcast(docs.sparkSession.createDataFrame(counts, "lang string, n long"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 40))
    drawn = known.select("doc_id", "lang").join(often, "lang").filter(draw < F.lit(4.0 * each * (1 << 40)) / F.col("n"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id")
    some = drawn.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= each)
    rows = known.join(F.broadcast(some.select("doc_id").distinct()), "doc_id", "left_semi").orderBy("doc_id", "lang", "text").limit(each * max(1, len(counts))).collect()
    return trained([r.text for r in rows], [r.lang for r in rows])


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of each row of `docs` (doc_id, text), from its whole text and nothing else.

    Null texts and texts without a letter are `und` with score 0; so is every text if there was nothing to learn from. Repeated rows
    and null doc_ids are predicted like others; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def predict(batches):
        for batch in batches:
            lang, score = predicted(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame) -> DataFrame:
    """`docs` without the rows that have no language: no letter, or text that is unusual for the language that is predicted for it.

    A text is cut into pieces; one is an outlier if its letter triples are less likely than those of almost all labelled pieces
    (`usual` sets the bound). Texts that have in the predicted language no quarter of other pieces go: gibberish, languages that nobody
    labelled, and what is taken for a language that it isn't like. Where no row has a `lang` to learn from, or no language has enough
    labelled pieces to tell what is usual, only a letter is asked for. Rows and columns are otherwise as they were; null texts go.
    """
    model = learned(docs)
    number = {k: i for i, k in enumerate(model.languages)}
    names = docs.columns
    small_batches(docs.sparkSession)

    def keep(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if number:
                lang, _ = predicted(texts, model)
                kept = [k != UNKNOWN and (not np.isfinite(model.spread[number[k]]) or is_usual(t, number[k], model)) for k, t in zip(lang, texts, strict=True)]
            else:
                kept = [any(c.isalpha() for c in t or "") for t in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema).select(names)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = languages(docs, learned(docs))
    return found.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "lang_pred", "score")
