"""A table of harvested records in buckets by their key, into which windows of a harvest are merged.

A version of the table is a manifest: which folder holds each bucket. A merge writes new folders for the buckets that its window touches and
then one new manifest, so readers see all of it or nothing, the other buckets' files stay as they are, and a merge that fails, or loses
a race against another, leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.ingest import newest_versions
from ..workspace import written

BUCKETS = 64
DELETED = "deleted"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def manifest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The newest version's number and content."""
    names = sorted(s.getPath().toString() for s in _fs(spark, path).globStatus(_path(spark, f"{path}/manifest-*.json")) or [])
    if not names:
        raise FileNotFoundError(f"no table in {path}")
    return int(names[-1][-13:-5]), json.loads(spark.read.option("wholetext", True).text(names[-1]).first().value)


def _publish(spark: SparkSession, path: str, version: int, content: dict) -> None:
    """Write a manifest beside the others and rename it: only one writer can make a version."""
    fs, to, draft = _fs(spark, path), f"{path}/manifest-{version:08d}.json", f"{path}/_draft-{uuid.uuid4().hex}"
    out = fs.create(_path(spark, draft), False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if fs.exists(_path(spark, to)) or not fs.rename(_path(spark, draft), _path(spark, to)):
        fs.delete(_path(spark, draft), False)
        raise RuntimeError(f"{path}: another merge has made version {version}; merge again")


def _write(df: DataFrame, path: str, key: str, buckets: int) -> dict[str, str]:
    """Folders of the buckets that `df` has rows in."""
    name = f"data-{uuid.uuid4().hex}"
    dealt = df.withColumn("bucket", bucket_of(key, buckets)).repartition(buckets, "bucket").sortWithinPartitions("bucket", key)
    dealt.write.partitionBy("bucket").option("compression", "zstd").parquet(f"{path}/{name}")
    found = _fs(df.sparkSession, path).globStatus(_path(df.sparkSession, f"{path}/{name}/bucket=*")) or []
    return {s.getPath().getName().removeprefix("bucket="): f"{name}/{s.getPath().getName()}" for s in found}


def create_table(df: DataFrame, path: str, key: str = "record_id", stamp: str = "datestamp", buckets: int = BUCKETS) -> None:
    """A new table of the newest version of each record of `df`, which has the columns `key`, `stamp` and `status`."""
    folders = _write(newest_versions(df, key, stamp), path, key, buckets)
    _publish(df.sparkSession, path, 1, {"key": key, "stamp": stamp, "buckets": buckets, "schema": df.schema.json(), "folders": folders})


def read_table(spark: SparkSession, path: str, deleted: bool = False, only: set[str] | None = None) -> DataFrame:
    """The newest version's records, without the `deleted` ones, which the table remembers; `only` some buckets."""
    from pyspark.sql.types import StructType

    _, content = manifest(spark, path)
    folders = [f"{path}/{f}" for k, f in content["folders"].items() if only is None or k in only]
    schema = StructType.fromJson(json.loads(content["schema"]))
    df = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return df if deleted else df.filter(~F.col("status").eqNullSafe(F.lit(DELETED)))


def merge_window(window: DataFrame, path: str) -> set[str]:
    """Merge a harvest window, of the table's columns, into it: records that are newer than the table's replace them, deleted ones
    too, older ones change nothing, and merging a window again changes nothing. Returns the buckets that were rewritten.

    Of a record's versions the newest counts; of equally new ones that of the window. Only buckets that the window has keys of are read
    and written; the bucket numbers, which are few, are all that reaches the driver.
    """
    spark = window.sparkSession
    version, content = manifest(spark, path)
    key, stamp, buckets = content["key"], content["stamp"], content["buckets"]
    new = written(newest_versions(window, key, stamp), "window")
    touched = {str(r.b) for r in new.select(bucket_of(key, buckets).alias("b")).distinct().collect()}
    if not touched:
        return touched
    both = read_table(spark, path, deleted=True, only=touched).withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    columns = [c for c in both.columns if c != "_new"]
    best = both.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(F.col(stamp), F.col("_new"))).alias("r")).select("r.*")
    folders = _write(best, path, key, buckets)
    _publish(spark, path, version + 1, content | {"folders": content["folders"] | folders})
    return touched


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove manifests but the newest `keep`, and the folders that none of those names: what older versions held, and what failed merges
    left. Returns how many folders went. Not to be run beside a merge or a reader of an older version."""
    fs = _fs(spark, path)
    found = sorted((s.getPath() for s in fs.globStatus(_path(spark, f"{path}/manifest-*.json")) or []), key=lambda p: p.getName())
    used = {f for p in found[-keep:] for f in json.loads(spark.read.option("wholetext", True).text(p.toString()).first().value)["folders"].values()}
    gone = 0
    for status in fs.globStatus(_path(spark, f"{path}/data-*/bucket=*")) or []:
        at = status.getPath()
        if f"{at.getParent().getName()}/{at.getName()}" not in used:
            gone += bool(fs.delete(at, True))
    for old in found[:-keep]:
        fs.delete(old, False)
    for draft in fs.globStatus(_path(spark, f"{path}/_draft-*")) or []:
        fs.delete(draft.getPath(), False)
    return gone


def merge_stream(windows: DataFrame, path: str, checkpoint: str) -> None:
    """Merge a stream of harvested records, batch by batch, until all that has landed is in the table. A batch that is tried again after
    a failure is merged again, which changes nothing, so each record's newest version is there once."""

    def merge(batch: DataFrame, _: int) -> None:
        merge_window(batch, path)

    windows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(merge).start().awaitTermination()
