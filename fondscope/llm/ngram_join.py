"""Operator 5: exact Jaccard join of documents on their five-word shingle sets, by set relations."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import setjoin as J
from .common import documents, salted_join, small_batches, text_or_empty, written
from .components import components


#: How often at most new heads are tried before all pairs that are left are compared. The result doesn't depend on it.
ROUNDS = 3


def _scan(batches):
    for batch in batches:
        ids, at = batch.column("doc_id"), 0
        for rec, h, n in J.of_texts(batch):
            key = J.set_key(rec, h, n)
            yield pa.RecordBatch.from_arrays([ids.slice(at, len(n)), pa.array(n, pa.int64()), pa.array(key.view("int64"))], ["doc_id", "n_shingles", "key"])
            at += len(n)


def _sets(batches):
    for batch in batches:
        ids, at = batch.column("doc_id"), 0
        for rec, h, n in J.of_texts(batch):
            offsets = pa.array([0, *n.cumsum().tolist()], pa.int32())
            yield pa.RecordBatch.from_arrays([ids.slice(at, len(n)), pa.array(n, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(h.view("int64")))], ["id", "n", "hashes"])
            at += len(n)


def size_class(n):
    """Sets of sizes within a ratio of 0.75 lie in the same class or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(4 / 3))).cast("int")


def merged(lists: DataFrame, links: DataFrame, comp: str | None) -> DataFrame:
    """`lists` with their sets' components `comp` after the new links, which are contracted to the components so far."""
    if comp:
        of = lists.select("id", "comp").distinct()
        links = links.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    lists, moved = lists.withColumn("at", F.col(comp or "id")), components(links).toDF("at", "to")
    out = salted_join(lists, moved, ["at"], ["id", "hash"], lists.groupBy("at").agg(F.count("*").alias("times")), lists.count(), "left")
    return out.withColumn("comp", F.coalesce("to", "at")).drop("at", "to")


def similar_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs` (doc_id, text).

    Words are runs other than 0x20 and 0x09-0x0D, A-Z lower-cased; sets and links are those of `setjoin`.
    Rows with equal sets are one class, carried by its smallest doc_id. Of the classes that can have a partner:

    1. each posting list's first set gives its answers to the sets that are highly similar to it: every set is verified
       against the first of its lists only, and the links found make preliminary components. This is repeated with other
       heads, for sets of other components than the head's, while it finds links (at most ROUNDS times);
    2. posting lists are cut into blocks of one component and size class, with the lowest position in each. A pair of
       blocks is skipped as a whole if it is of one component (membership is known from step 1), if the size
       classes aren't neighbours, or if the best positions can't reach the needed overlap;
    3. the pairs of the blocks left are filtered by length and position and verified on the whole sets. Components whose blocks
       meet in many lists are paired once, member by member, if that gives fewer pairs.

    So no two sets that are already known to be connected are compared, and no list's pairs are all emitted. Only component
    membership is derived: links inside a component are not enumerated, and a set's own answers are nowhere listed.
    Null and empty texts have no shingle and are linked with nothing; rows with one doc_id are one vertex; repeated rows
    appear as often as they occur. Null doc_id: kept, in a component of its own (null). Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = written(docs.mapInArrow(_scan, "doc_id long, n_shingles long, key long"), "sets")
    classes = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("key", "n_shingles").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last"), F.count("*").alias("times"))
    hopeful = J.promising(docs.filter("doc_id IS NOT NULL"), J.of_texts, J.entries(rows, "n_shingles"))
    chosen = written(classes.join(hopeful, "key").filter(J.can_link("n_shingles")).select(F.col("id").alias("doc_id")), "chosen")
    sets = written(J.semi(docs, chosen, "doc_id").mapInArrow(_sets, "id long, n int, hashes array<long>").filter("n > 0"), "members")
    lists = written(J.prefixes(sets), "lists")

    links, comp = None, None
    for turn in range(ROUNDS):
        rank = F.xxhash64("id", "hash", F.lit(turn)) if turn else F.col("id")
        near = J.first_of_lists(lists, rank).filter(F.col(comp or "id") != F.col(f"head.{comp or 'id'}"))
        near = near.filter(J.may_reach(F.col("n"), F.col("pos"), F.col("head.n"), F.col("head.pos"))).select(F.least("id", "head.id").alias("a"), F.greatest("id", "head.id").alias("b")).distinct()
        found = written(J.linked(near, sets), "links")
        links = found if links is None else links.union(found)
        if turn and found.isEmpty():
            break
        lists, comp = written(merged(lists, found, comp), "lists"), "comp"
    lists = lists.withColumn("size", size_class(F.col("n")))
    blocks = lists.groupBy("hash", "comp", "size").agg(F.min("pos").alias("pos"), F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("count"))
    mixed = blocks.groupBy("hash").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("hash")
    blocks = blocks.join(mixed, "hash", "left_semi")
    one, two = (blocks.select("hash", *(F.col(c).alias(f"{c}_{k}") for c in ("comp", "size", "pos", "least", "most", "count"))) for k in "ab")
    best = F.least(F.col("most_a") - F.col("pos_a"), F.col("most_b") - F.col("pos_b"))
    meet = one.join(two, "hash").filter((F.col("comp_a") < F.col("comp_b")) & (F.abs(F.col("size_a") - F.col("size_b")) <= 1) & ((100 + J.PERCENT) * best >= J.PERCENT * (F.col("least_a") + F.col("least_b"))))
    groups = ["comp_a", "size_a", "comp_b", "size_b"]
    meet = written(meet.select("hash", *groups, (F.col("count_a") * F.col("count_b")).alias("pairs")), "meet")
    members = lists.select("comp", "size", "id", "n").distinct()
    counts = members.groupBy("comp", "size").agg(F.count("*").alias("m"))
    often = meet.groupBy(*groups).agg(F.sum("pairs").alias("pairs"))
    often = often.join(counts.toDF("comp_a", "size_a", "m_a"), groups[:2]).join(counts.toDF("comp_b", "size_b", "m_b"), groups[2:])
    often = often.filter("m_a * m_b < pairs").select(*groups)  # these meet in so many lists that to pair their members once is less
    by_member = often.join(members.toDF("comp_a", "size_a", "a", "n_a"), groups[:2]).join(members.toDF("comp_b", "size_b", "b", "n_b"), groups[2:])
    by_member = by_member.filter(100 * F.least("n_a", "n_b") >= J.PERCENT * F.greatest("n_a", "n_b")).select("a", "b")
    post = [lists.select("hash", *(F.col(c).alias(f"{c}_{k}") for c in ("comp", "size", "id", "n", "pos"))) for k in "ab"]
    by_list = meet.join(often, groups, "left_anti").drop("pairs").join(post[0], ["hash", *groups[:2]]).join(post[1], ["hash", *groups[2:]])
    by_list = by_list.filter(J.may_reach(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"))).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    pairs = by_member.union(by_list).distinct()
    rest = J.linked(pairs, sets)

    copies, of = written(classes.filter("id < last").select("key", "n_shingles", "id", "times"), "copies"), ["key", "n_shingles"]
    same = salted_join(rows, copies.drop("times"), of, ["doc_id"], copies.select(*of, "times"), rows.count())
    same = same.filter("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    final = components(links.union(rest).union(same)).select(F.col("id").alias("doc_id"), F.col("component").alias("component_id"))
    return rows.join(final, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` without the documents whose component has one with a smaller doc_id: one of each group stays.

    Rows with one doc_id are one document and stay or go together; documents without words stay.
    """
    found = similar_sets(docs).filter("n_shingles > 0")
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(documents(spark, sf_dir))
