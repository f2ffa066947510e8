"""What the operators share: intermediate tables, joins that hot keys don't stop, batches of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import new_path, written

#: A side of a join is broadcast only when it has been counted and is not above this many bytes.
BROADCAST_BYTES = 32 << 20
#: Rows of one key that a task may always gather.
SPLIT = 1000


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000, most: int = 16 << 20) -> None:
    """Python workers get at most `rows` rows, and about `most` bytes, at a time, so that long texts don't fill their memory.

    The settings are the session's, and are only ever lowered."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", most)):
        if int(spark.conf.get(key).rstrip("b")) > value:
            spark.conf.set(key, str(value))


def bounded_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """`df`, marked for broadcast if its counted rows take at most BROADCAST_BYTES; else left to a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def salted_join(rows: DataFrame, one: DataFrame, on: Sequence[str], by: Sequence[str], times: DataFrame, total: int, how: str = "inner") -> DataFrame:
    """`rows` joined with `one`, which has one row for each key `on`; no task gathers the rows of a hot key.

    times (*on, times) tells how many rows have a key, and adds up to `total` at most. A key of more than a quarter of a
    partition's share, and of more than SPLIT rows, is cut into as many parts as it has such quarters, by a hash of `by`, and its row
    of `one` repeated for each. There are at most four such keys for each partition: these are collected, and broadcast.
    """
    part = max(SPLIT, total // (4 * partitions(rows.sparkSession)))
    hot = times.filter(F.col("times") > part).select(*on, F.ceil(F.col("times") / part).cast("int").alias("salts"))
    keys = hot.collect() if total > SPLIT else []
    if not keys:
        return rows.join(one, list(on), how)
    hot = rows.sparkSession.createDataFrame(keys, hot.schema)
    hot, salts = F.broadcast(hot), F.coalesce("salts", F.lit(1))
    left = rows.join(hot, list(on), "left").withColumn("salt", F.pmod(F.xxhash64(*by), salts).cast("int")).drop("salts")
    right = one.join(hot, list(on), "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return left.join(right, [*on, "salt"], how).drop("salt")


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write `df` once and read it back; and where it lies, for `removed`. For tables of rounds, of which only the last is needed."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


__all__ = ["BROADCAST_BYTES", "bounded_broadcast", "documents", "partitions", "removed", "salted_join", "small_batches", "stored", "text_or_empty", "written"]
