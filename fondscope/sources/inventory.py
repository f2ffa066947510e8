"""Files of a dataset: sizes, versions, dates and changes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import size_text


def file_inventory(spark: SparkSession, path: str | list[str], kind: str = "parquet") -> DataFrame:
    """(file, bytes, size) of a dataset's files in order of their names without `.parquet`."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.parquet\z", "")
    return files.select(name.alias("file"), "bytes", size_text("bytes").alias("size")).orderBy("file")


_PARTS = (F.count, "*", "rows"), (F.bit_xor, "h", "xor"), (F.sum, "p", "sum")


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, rows, xor, sum): a version of the table's content, or with `by` of each partition's other columns, that doesn't depend on the
    order of rows or on files, from MD5 digests of the rows: 60 bits of them xored, 24 bits summed (equal rows cancel in the one
    but not in the other)."""
    shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in df.columns if c not in by]
    h = F.md5(F.concat_ws("|", *(F.concat(F.length(x).cast("string"), F.lit(":"), x) for x in shown)))
    whole, part = (F.conv(F.substring(h, at, n), 16, 10).cast("long") for at, n in ((1, 15), (17, 6)))
    return df.select(*by, whole.alias("h"), part.alias("p")).groupBy(*by).agg(*(f(c).alias(to) for f, c, to in _PARTS))


def combined_fingerprints(*parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The fingerprint of several tables together, from their own (rows, xor, sum), without reading any of them again: what files that are
    added to a dataset or partition make of its fingerprint."""
    every = reduce(DataFrame.unionByName, (p.select(*by, "rows", "xor", "sum") for p in parts))
    return every.groupBy(*by).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.bit_xor("xor").alias("xor"), F.sum("sum").alias("sum"))


def file_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """(files, sha1): the version of a dataset's files: the SHA-1 digest of their digests in order of their names. Each file is
    digested where it is read (of 2 GB at most, as Spark reads whole files)."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha1("content").alias("sha1"))
    every = F.transform(F.sort_array(F.collect_list(F.struct("name", "sha1"))), lambda f: f["sha1"])
    return files.agg(F.count("*").alias("files"), F.sha1(F.array_join(every, "").cast("binary")).alias("sha1"))


def changed_sources(current: DataFrame, manifest: DataFrame) -> DataFrame:
    """(url, state) of sources (url, etag) that are new, removed, changed, or can't be compared for want of an etag."""
    a, b = current.select("url", F.col("etag").alias("now"), F.lit(True).alias("is")), manifest.select("url", F.col("etag").alias("then"), F.lit(True).alias("was"))
    state = F.when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "removed").when(F.col("now").isNull(), "unknown").when(~F.col("now").eqNullSafe(F.col("then")), "changed")
    return a.join(b, "url", "full").select("url", state.alias("state")).filter("state is not null")


def dataset_date(dates: DataFrame | None, files: DataFrame | None = None, fixed: str | None = None, first: bool = False) -> DataFrame:
    """(date): the greatest stripped text of `dates` (value); else the newest `modified` of `files` in UTC (`first`: that of the
    file whose name comes first); else the fixed one; else ''."""
    from ..functions import stripped

    out = None
    if dates is not None:
        out = dates.agg(F.max(stripped("value")).alias("a"))
    if files is not None:
        newest = files.agg(F.date_format(F.min_by("modified", "file") if first else F.max("modified"), "yyyy-MM-dd").alias("b"))
        out = newest if out is None else out.crossJoin(F.broadcast(newest))  # one row each
    if out is None:
        raise ValueError("neither dates nor files")
    have = [F.nullif(F.col(c), F.lit("")) for c in out.columns]
    return out.select(F.coalesce(*have, F.lit(fixed or "")).alias("date"))


def modification_times(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"))
