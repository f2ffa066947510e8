"""Rows of one field, numeric values, and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import digits_only


def select_field(d: DataFrame, field: str, subfield: str | None = None) -> DataFrame:
    """Rows of a field, or of one subfield of it; both tests reach the Parquet scan."""
    d = d.filter(F.col("field_code") == field)
    return d if subfield is None else d.filter(F.col("subfield_code") == subfield)


def numeric_values(df: DataFrame, col: str = "value") -> DataFrame:
    """Rows whose `col` is ASCII digits only."""
    return df.filter(digits_only(col))


def seeded(seed: int | str, *cols) -> Column:
    """A repeatable random order of values: a digest of the seed and the columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *cols))


def sample_per_group(df: DataFrame, keys: Sequence[str], order_col: str, k: int, seed: int | str) -> DataFrame:
    """k random rows of each group and their rank `rn`, nulls of `order_col` last. Spark cuts each partition's groups to k before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col(order_col).isNull(), seeded(seed, order_col), order_col)
    return df.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)


def sample_records(d: DataFrame, percent: float, seed: int | str) -> DataFrame:
    """All rows of about `percent` of the records, the same for every run and partitioning; no shuffle."""
    bound = format(min(0xFFFFFFFF, int(percent / 100 * 0x100000000)), "08x")
    return d if percent >= 100 else d.filter(F.substring(seeded(seed, F.col("record_number").cast("string")), 1, 8) < bound)


def sample_rows(df: DataFrame, percent: float, seed: int) -> DataFrame:
    """About `percent` of the rows, by Spark's Bernoulli sample."""
    return df.sample(fraction=percent / 100, seed=seed)


def sample_blocks(d: DataFrame, percent: float, seed: int | str) -> DataFrame:
    """The rows of about `percent` of a table's files, drawn by a seeded digest of their names, with `weight`: what a row counts for in
    estimates of the whole. `d` is read from files; as the draw depends on their names only, what isn't drawn isn't read. The files of
    `write_attributes` are bounded in rows, so estimates vary little; each file has the same chance, so they aren't biased."""
    bound = format(min(0xFFFFFFFF, int(percent / 100 * 0x100000000)), "08x")
    drawn = d if percent >= 100 else d.filter(F.substring(seeded(seed, F.col("_metadata.file_name")), 1, 8) < bound)
    return drawn.withColumn("weight", F.lit(100.0 / min(100.0, percent)))
