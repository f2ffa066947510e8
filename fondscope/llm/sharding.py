"""Operator 6: shards of nearly equal bytes, by sampled splitters."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, text_or_empty, written

SHARDS = 40
OVERHEAD = 16
#: Ranges for each shard at least, rows that one range should hold at most, and keys drawn for each range.
FINENESS, RANGE_ROWS, DRAWS = 16, 1 << 20, 16
#: Groups of equal texts above this part of a shard are placed one by one. There are at most shards / HEAVY of them.
HEAVY = 0.01
_CELLS = 1 << 24


def splitters(rows: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Quantile boundaries of the key from a size-weighted sample.

    A row is drawn with a chance in proportion to its size, so about DRAWS * ranges keys (16 bytes each) reach the driver;
    a row that is larger than a draw's share counts for as many draws.
    """
    chance = F.col("size") * F.lit(DRAWS * ranges / max(1, total))
    drawn = rows.filter(F.pmod(F.xxhash64("key", "row", F.lit(6)), F.lit(1_000_003)) / 1_000_003.0 < chance)
    got = drawn.select("key", F.greatest(F.lit(1.0), chance).alias("weight")).toPandas().sort_values("key")
    if ranges < 2 or got.empty:
        return np.zeros(0, np.int64)
    upto = got.weight.cumsum().to_numpy()
    return np.unique(got.key.to_numpy()[np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges)])


def range_of(value, cuts: np.ndarray):
    """How many of the sorted boundaries are at most the value."""

    @F.pandas_udf("int")
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(), "right").astype(np.int32))

    return place(value)


def spread_groups(groups: list[tuple[int, int]], shards: int, share: float) -> tuple[dict[int, list[tuple[float, int]]], np.ndarray]:
    """For each group (key, bytes), (bytes up to which, shard) of its parts; and the room that is left in each shard.

    The largest go first, each to the emptiest shard. A group is cut only if that one has no room for all of it.
    """
    room = [(-share, k) for k in range(shards)]
    out: dict[int, list[tuple[float, int]]] = {}
    for key, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        done, parts = 0.0, []
        while done < size:
            free, k = heapq.heappop(room)
            take = size - done if size - done <= -free or -free <= 1 else -free
            done += take
            parts.append((done, k))
            heapq.heappush(room, (free + take, k))
        out[key] = parts
    left = np.zeros(shards)
    for free, k in room:
        left[k] = max(0.0, -free)
    return out, left


def shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of `docs` (doc_id, text).

    A row's key is a hash of its text, so equal texts are neighbours and go to one shard; a group of equal texts is cut only if it
    fits in no shard (`spread_groups`). The groups above HEAVY of a shard, which these are, are placed first. Of the other
    rows' keys a size-weighted sample gives quantile boundaries; rows are range-partitioned by them, and a range that
    turns out overfull is subdivided by a hash of the key. Exact bytes of the ranges, in order, give each group the place of its
    middle in all bytes, which decides the shard by the room left there. So shards differ by about HEAVY of a shard or one
    row, whichever is more. A heavy group's rows are dealt to cells, so that no task gathers them. slot numbers a shard's rows
    from 0 without gaps.

    Null texts count as empty; null doc_ids are rows like others; repeated rows are kept, each with its own slot; an empty table
    gives no rows. Only rows' keys and sizes are shuffled, never texts. Other columns are ignored.
    """
    text, spark = text_or_empty(), docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    share, ranges = max(1.0, total / shards), max(FINENESS * shards, -(-n // RANGE_ROWS))
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > HEAVY * share)
    groups = [(r.key, r.bytes) for r in groups.collect()]  # at most shards / HEAVY, as they are that part of all bytes
    parts, room = spread_groups(groups, shards, share)
    cells = {k: max(1, round(b * ranges / (2 * total))) for k, b in groups}
    heavy = [(k, i, cells[k], [float(at) for at, _ in p[:-1]], [s for _, s in p]) for i, (k, p) in enumerate(parts.items())]
    heavy = F.broadcast(spark.createDataFrame(heavy, "key long, heavy int, cells int, cuts array<double>, to array<int>"))

    small = rows.join(heavy, "key", "left_anti")
    small = small.withColumn("range", range_of(F.col("key"), splitters(small, total, ranges)))
    small = written(small, "ranges")
    full = small.groupBy("range").agg(F.greatest(F.lit(1), F.ceil(F.sum("size") * F.lit(ranges / 2 / max(1, total)))).alias("parts"))
    small = small.join(F.broadcast(full), "range").withColumn("cell", F.col("range").cast("long") * _CELLS + F.pmod(F.xxhash64("key"), F.col("parts")))
    inside = Window.partitionBy("cell").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("cell", "key")
    small = small.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    small = small.withColumn("middle", F.min("before").over(group) + F.sum("size").over(group) / 2)
    small = _from_start(small, ()).withColumn("shard", range_of(F.col("middle"), np.cumsum(room)[:-1]))

    large = rows.join(heavy, "key").withColumn("cell", (ranges + 1 + F.col("heavy")).cast("long") * _CELLS + F.pmod(F.xxhash64("row"), F.col("cells")))
    inside = Window.partitionBy("cell").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    large = _from_start(large.withColumn("middle", F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2), ("heavy",))
    large = large.withColumn("shard", F.get("to", F.size(F.filter("cuts", lambda c: c <= F.col("middle")))))

    names = ["doc_id", "size", "text_crc32", "key", "row", "cell", "shard"]
    placed = written(small.select(*names).unionByName(large.select(*names)), "placed")
    upto = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy("shard", "cell").count().select("shard", "cell", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("first"))  # few more than cells
    nth = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("key", "row")) - 1
    return placed.withColumn("nth", nth).join(first, ["shard", "cell"]).select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("nth")).cast("long").alias("slot"))


def _from_start(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """`rows` with `middle` counted from the first cell (of each of `by`), not from the row's own. One row a cell is summed up."""
    upto = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*by, "cell").agg(F.sum("size").alias("bytes"))
    return rows.join(sums.select("cell", F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("start")), "cell").withColumn("middle", F.col("middle") + F.col("start"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = shards(documents(spark, sf_dir))
    return made.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
