"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import functools
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when it has been counted and is not above this many bytes.
BROADCAST_BYTES = 32 << 20

#: Attribute rows, and records with all of their fields, that a task is dealt at most on average.
ROWS, RECORDS = 1_000_000, 50_000


def partitions_for(spark: SparkSession, n: int, each: int = ROWS) -> int:
    """How many partitions `n` rows are dealt to: `each` rows a task, but at least Spark's number of shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // each))


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one where that is unset and all run on one machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them share")
        found = tempfile.mkdtemp(prefix="fondscope-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def once(f: Callable) -> Callable:
    """`f` (spark, sf_dir, ...), which writes something and returns its path, called once in an application for the same arguments."""
    paths: dict[tuple, str] = {}

    @functools.wraps(f)
    def found(spark: SparkSession, sf_dir: str, *args) -> str:
        key = (spark.sparkContext.applicationId, sf_dir, *args)
        if key not in paths:
            paths[key] = f(spark, sf_dir, *args)
        return paths[key]

    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/fondscope-{name}-{uuid.uuid4().hex}"


_held = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What this thread has `written` inside goes at the end, and not only with the driver: for steps whose result is stored elsewhere."""
    outer, _held.paths = getattr(_held, "paths", None), []
    try:
        yield
    finally:
        for path in _held.paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _held.paths = outer


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back, so that later plans start from files and survive lost executors. The files go when the
    driver ends."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if getattr(_held, "paths", None) is not None:
        _held.paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """`df`, marked for broadcast if its counted rows take at most BROADCAST_BYTES; else left to a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
