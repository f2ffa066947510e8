"""Operator 9: lines that repeat or nearly repeat an earlier line go, by an exact set-similarity join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import setjoin as J
from . import words
from .common import BROADCAST_BYTES, bounded_broadcast, documents, small_batches, written

_SCHEMA = "doc_id long, version long, line int, n int, key long"


def line_starts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of the lines of all texts (one more than lines), each line's text, and its number there."""
    breaks = np.flatnonzero(data[at[0] : at[-1]] == 10) + 1 + at[0]
    bounds = np.unique(np.concatenate([at, breaks]))
    text = np.searchsorted(at, bounds[:-1], "right") - 1
    number = np.arange(len(text)) - np.searchsorted(bounds, at[text])
    return bounds, text, number


def of_lines(batch: pa.RecordBatch):
    data, at = words.bytes_of(batch.column("text"))
    if len(at) > 1 and at[-1] > at[0]:
        for s in words.slices(data, line_starts(data, at)[0]):
            yield words.distinct_shingles(s)


def _scan(batches):
    for batch in batches:
        data, at = words.bytes_of(batch.column("text"))
        if len(at) < 2 or at[-1] == at[0]:
            continue
        _, text, number = line_starts(data, at)
        keys, sizes = [], []
        for rec, h, n in of_lines(batch):
            keys.append(J.set_key(rec, h, n))
            sizes.append(n)
        key, n = np.concatenate(keys), np.concatenate(sizes)
        some = np.flatnonzero(n)
        where = pa.array(text[some])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(where), batch.column("version").take(where), pa.array(number[some], pa.int32()), pa.array(n[some], pa.int32()), pa.array(key[some].view("int64"))], ["doc_id", "version", "line", "n", "key"])


def _chosen(batches):
    """Sets of the lines whose key the row asks for."""
    for batch in batches:
        wanted = batch.column("keys")
        data, at = words.bytes_of(batch.column("text"))
        if len(at) < 2 or at[-1] == at[0]:
            continue
        _, text, _ = line_starts(data, at)
        sizes = np.diff(np.asarray(wanted.offsets))
        lo = wanted.offsets[0].as_py()
        asked = np.asarray(wanted.values)[lo : lo + sizes.sum()].view("uint64")
        pairs = set(zip(np.repeat(np.arange(len(sizes)), sizes).tolist(), asked.tolist(), strict=True))
        first, seen = 0, set()
        for rec, h, n in of_lines(batch):
            key = J.set_key(rec, h, n)
            ends = np.cumsum(n)
            picked = np.flatnonzero(np.isin(key, asked))
            rows = []
            for k in picked.tolist():
                x = (int(text[first + k]), int(key[k]))
                if x in pairs and x not in seen:
                    seen.add(x)
                    rows.append((int(key[k : k + 1].view("int64")[0]), int(n[k]), h[ends[k] - n[k] : ends[k]].view("int64")))
            first += len(n)
            if rows:
                ids, ns, hs = zip(*rows, strict=True)
                offsets = pa.array(np.cumsum([0, *ns]), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(hs)))], ["id", "n", "hashes"])


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, version, lines): of `docs` (doc_id, version, text), the numbers of the lines that match an earlier line.

    A line's set is that of its five-word shingles, as for documents (fewer words: all of them as one; none: never a match).
    Lines are in order of doc_id (null first), version and number, and two match at a Jaccard similarity of 0.75 or more. A line
    goes if any earlier line matches it, whether that one goes or stays. Steps:

    1. equal sets are one class, whose first line can stay and whose others go;
    2. of the classes that can have a partner, shingles are ordered by rarity; two matching lines share one of their
       prefixes, at positions and with lengths that can still reach the similarity;
    3. a class is verified against the earliest of each of its lists. Only those that match none of these are verified
       against all earlier classes of their lists, which lie in neighbouring classes of length.
    """
    spark = docs.sparkSession
    lines = written(docs.mapInArrow(_scan, _SCHEMA), "lines")
    when = F.struct("doc_id", "version", "line")
    classes = written(lines.groupBy("key", "n").agg(F.min(when).alias("first"), F.count("*").alias("times")), "classes")
    chosen = written(classes.join(J.promising(docs, of_lines, J.entries(lines)), "key").filter(J.can_link()).select(F.col("key").alias("id"), "n", "first"), "chosen")
    asked = chosen.groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.version").alias("version")).agg(F.collect_set("id").alias("keys"))
    asked = written(asked, "asked")
    keys = asked.agg(F.sum(F.size("keys") + 4)).first()[0] or 0
    few = F.broadcast(asked) if keys * 8 <= BROADCAST_BYTES else asked  # counted, and small
    a, b = docs.alias("a"), few.alias("b")
    texts = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.version") == F.col("b.version"))).select("a.text", "b.keys")
    sets = written(texts.mapInArrow(_chosen, "id long, n int, hashes array<long>"), "members").dropDuplicates(["id", "n"])
    lists = written(J.prefixes(sets).join(chosen.select("id", "first"), "id"), "lists")

    heads = lists.groupBy("hash").agg(F.min(F.struct("first", "id", "n", "pos")).alias("head"))
    near = lists.join(heads, "hash").filter(F.col("first") > F.col("head.first"))
    near = near.filter(J.may_reach(F.col("n"), F.col("pos"), F.col("head.n"), F.col("head.pos"))).select(F.col("id").alias("a"), F.col("head.id").alias("b")).distinct()
    late = written(J.linked(near, sets).select(F.col("a").alias("id")).distinct(), "late")

    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("int")
    open_ = lists.join(bounded_broadcast(late, 16), "id", "left_anti").select("hash", F.explode(F.array(size - 1, size, size + 1)).alias("size"), F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("pos_a"), F.col("first").alias("first_a"))
    earlier = lists.select("hash", size.alias("size"), F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"), F.col("first").alias("first_b"))
    pairs = open_.join(earlier, ["hash", "size"]).filter((F.col("first_b") < F.col("first_a")) & J.may_reach(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"))).select("a", "b").distinct()
    late = written(late.union(J.linked(pairs, sets).select(F.col("a").alias("id"))).distinct(), "late")

    doubtful = classes.join(late.select(F.col("id").alias("key"), F.lit(True).alias("late")), "key", "left").filter("times > 1 OR late")
    gone = lines.join(doubtful.select("key", "n", "first", "late"), ["key", "n"]).filter(F.col("late").isNotNull() | (when != F.col("first")))
    return gone.groupBy("doc_id", "version").agg(F.collect_set("line").alias("lines"))


_MADE = {k: f"line_dedup {k}" for k in ("doc", "version", "lines", "n_lines", "n_removed")}  # names that no table has


def _cut(batches):
    """Texts without the lines that go, and how many lines there were and went."""
    for batch in batches:
        texts, counts, removed = batch.column("text").to_pylist(), [], []
        for i, (text, lines) in enumerate(zip(texts, batch.column(_MADE["lines"]).to_pylist(), strict=True)):
            counts.append(0 if text is None else text.count("\n") + 1)
            removed.append(len(lines or ()))
            if lines:
                gone = set(lines)
                texts[i] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        batch = batch.drop_columns([_MADE["lines"]])
        at = batch.schema.get_field_index("text")
        batch = batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))
        yield batch.append_column(_MADE["n_lines"], pa.array(counts, pa.int64())).append_column(_MADE["n_removed"], pa.array(removed, pa.int64()))


def _cleaned(docs: DataFrame) -> DataFrame:
    """`docs` with its texts less the repeated lines, and how many lines there were and went, under the names in _MADE."""
    small_batches(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    m = {k: F.col(f"`{v}`") for k, v in _MADE.items()}
    text = F.coalesce(F.col("text"), F.lit(""))
    gone = repeated_lines(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text")))
    gone = gone.select(F.col("doc_id").alias(_MADE["doc"]), F.col("version").alias(_MADE["version"]), F.col("lines").alias(_MADE["lines"]))
    gone = written(gone, "gone")
    size = gone.agg(F.sum(F.size(F.col(f"`{_MADE['lines']}`")) * 8 + 64)).first()[0] or 0
    gone = F.broadcast(gone) if size <= BROADCAST_BYTES else gone.hint("shuffle_hash")  # counted: then no text is shuffled
    full = docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(m["doc"]) & (F.xxhash64(text) == m["version"]), "left")
    full = full.select(m["lines"], *(F.col(f"`{c}`") for c in docs.columns))
    made = StructType([*docs.schema.fields, *(StructField(_MADE[k], LongType()) for k in ("n_lines", "n_removed"))])
    return full.mapInArrow(_cut, made)


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with its texts less the repeated lines, and the columns n_lines and n_removed.

    Lines are split at line feeds and joined again; a null text stays null (0 lines), an empty one has one empty line. Rows equal
    in doc_id and text are one document: they lose the same lines. Other columns stay, but for ones named n_lines and n_removed.
    """
    out = _cleaned(docs)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*(F.col(f"`{c}`") for c in names), F.col(f"`{_MADE['n_lines']}`").alias("n_lines"), F.col(f"`{_MADE['n_removed']}`").alias("n_removed"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """`docs` less the repeated lines and less the documents of which no word is left; n_chars is counted again."""
    out, changed = _cleaned(docs), F.col(f"`{_MADE['n_removed']}`") > 0
    out = out.filter(~changed | F.col("text").rlike(r"[^ \t-\r]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
