"""Harvested OAI records and search pages, once they have landed as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RECORD = "leader string, controlfield array<struct<_tag:string,_VALUE:string>>, datafield array<struct<_tag:string,_ind1:string,_ind2:string,subfield:array<struct<_code:string,_VALUE:string>>>>"
OAI_SCHEMA = f"header struct<_status:string,identifier:string,datestamp:string,setSpec:string>, metadata struct<record:struct<{', '.join(x.replace(' ', ':', 1) for x in _RECORD.split(', '))}>>, _corrupt_record string"


def read_oai(spark: SparkSession, path) -> DataFrame:
    """Records of OAI-PMH responses: header and metadata."""
    read = spark.read.format("xml").option("rowTag", "record").option("ignoreNamespace", True).option("ignoreSurroundingSpaces", False)
    return read.option("columnNameOfCorruptRecord", "_corrupt_record").schema(OAI_SCHEMA).load(path).filter(F.col("header").isNotNull())


def oai_records(df: DataFrame, full_record: bool = False) -> DataFrame:
    """Records that aren't deleted: only their payload, or with `full_record` the whole of them."""
    live = df.filter(~F.col("header._status").eqNullSafe(F.lit("deleted")))
    return live if full_record else live.select("metadata.*")


def oai_window(df: DataFrame, start: str | None = None, end: str | None = None, set_spec: str | None = None) -> DataFrame:
    """Records stamped from `start` to `end`, both included, of one set; None leaves a side open."""
    stamp = F.col("header.datestamp")
    for condition in ([stamp >= start] if start else []) + ([stamp <= end] if end else []) + ([F.col("header.setSpec") == set_spec] if set_spec else []):
        df = df.filter(condition)
    return df


def read_pages(spark: SparkSession, path) -> DataFrame:
    """Search response pages, one file each: (file, content)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("content"))


def read_bundled_pages(spark: SparkSession, path) -> DataFrame:
    """Search response pages, many to a file, as JSON lines: (harvest, start, content). A large harvest lands so; with a file for each page,
    opening and listing files takes longer than all else."""
    return spark.read.schema("harvest string, start long, content string").json(path)


#: Positions of a harvest that are looked at together.
SPAN = 1 << 20


def page_records(content: str = "content", tag: str = "record") -> Column:
    """How many records a landed page holds: opening tags of this name, whatever their namespace."""
    return F.regexp_count(F.col(content), F.lit(rf"<(?:[A-Za-z0-9]+:)?{tag}[ >/]")).cast("long")


def reconciled(pages: DataFrame, declared: DataFrame, span: int = SPAN) -> DataFrame:
    """(harvest, kind, first, last, records): what landed pages (harvest, start, records) lack of, or have beyond, the positions 1 to
    total that are `declared` (harvest, total), one row for each range. Kinds: missing (in no page), doubled (in more than one) and
    undeclared (beyond the total); harvests whose pages are all right have no row.

    Pages are cut at multiples of `span`, and each stretch is looked at by itself, so a large harvest is no hot group; only
    ranges that are wrong are then joined across these cuts. Pages without records, or without a harvest, count for nothing.
    """
    cut = F.explode(F.sequence(F.floor(F.col("lo") / span), F.floor((F.col("hi") - 1) / span))).alias("stretch")
    covered = pages.select("harvest", F.col("start").cast("long").alias("lo"), (F.col("start") + F.col("records")).cast("long").alias("hi"), F.lit(1).alias("by"))
    wanted = declared.select("harvest", F.lit(1).cast("long").alias("lo"), (F.col("total") + 1).cast("long").alias("hi"), F.lit(0).alias("by"))
    parts = covered.unionByName(wanted).filter("hi > lo and harvest is not null").select("harvest", "lo", "hi", "by", cut)
    parts = parts.withColumn("lo", F.greatest("lo", F.col("stretch") * span)).withColumn("hi", F.least("hi", (F.col("stretch") + 1) * span))
    ends = F.inline(F.array(*(F.struct(F.col(c).alias("at"), (F.col("by") * k).alias("step"), ((1 - F.col("by")) * k).alias("step_wanted")) for c, k in (("lo", 1), ("hi", -1)))))
    steps = parts.select("harvest", "stretch", ends).groupBy("harvest", "stretch", "at").agg(F.sum("step").alias("step"), F.sum("step_wanted").alias("step_wanted"))
    order = Window.partitionBy("harvest", "stretch").orderBy("at")
    ranges = steps.select("harvest", F.col("at").alias("first"), (F.lead("at").over(order) - 1).alias("last"), F.sum("step").over(order).alias("times"), F.sum("step_wanted").over(order).alias("wanted")).filter("last is not null")
    kind = F.when((F.col("times") == 0) & (F.col("wanted") > 0), "missing").when((F.col("times") > 0) & (F.col("wanted") == 0), "undeclared").when(F.col("times") > 1, "doubled")
    wrong = ranges.select("harvest", kind.alias("kind"), "first", "last").filter("kind is not null")
    along = Window.partitionBy("harvest", "kind").orderBy("first")
    fresh = F.when(F.col("first") == F.lag("last").over(along) + 1, 0).otherwise(1)
    islands = wrong.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(along))
    return islands.groupBy("harvest", "kind", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).select("harvest", "kind", "first", "last", (F.col("last") - F.col("first") + 1).alias("records"))


def harvest_audit(pages: DataFrame, batch: int, harvest: str = "harvest", start: str = "start", content: str = "content") -> DataFrame:
    """(harvest, total, pages_expected, pages_found, missing) of landed pages: declared total, how many pages that makes and the
    starts of those that are missing. Pages start at 1, 1 + batch, ... up to and including the total."""
    total = F.regexp_extract(content, "numberOfRecords>([0-9]*)</", 1).try_cast("long")
    seen = pages.select(F.col(harvest).alias("harvest"), F.col(start).cast("long").alias("start"), total.alias("total"))
    declared = seen.groupBy("harvest").agg(F.coalesce(F.max("total"), F.lit(0)).alias("total"))
    wanted = declared.filter("total > 0").select("harvest", F.explode(F.sequence(F.lit(1).cast("long"), F.col("total"), F.lit(batch).cast("long"))).alias("start"))
    missing = wanted.join(seen.select("harvest", "start").distinct(), ["harvest", "start"], "left_anti")
    lost = missing.groupBy("harvest").agg(F.count("*").alias("lost"), F.min("start").alias("first_missing"))
    found = seen.groupBy("harvest").agg(F.count_distinct("start").alias("pages_found"))
    out = declared.join(found, "harvest").join(lost, "harvest", "left")
    return out.select("harvest", "total", F.ceil(F.col("total") / batch).cast("long").alias("pages_expected"), "pages_found", F.coalesce("lost", F.lit(0)).cast("long").alias("pages_missing"), "first_missing")
