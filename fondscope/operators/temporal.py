"""Years of records. One scan of the three fields that carry years and languages gives both rules' rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import digits_only, marc_year, to_year
from ..schema import YEARS


def _carries_year() -> Column:
    return F.col("field_code").isin("008", "011@") & ((F.col("field_code") == "008") | (F.col("subfield_code") == "a"))


def _year_text() -> Column:
    return F.when(F.col("field_code") == "008", marc_year("value")).otherwise(F.col("value"))


def record_years(d: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, record_number, year): PICA 011@ $a, and places 8 to 11 of MARC 008, where they are digits.

    A row for each such field, not for each record; the year is null if the digits are too many for an integer.
    """
    text = _year_text()
    rows = d.filter(_carries_year())
    return rows.select(*by, "record_number", text.alias("text")).filter(digits_only("text")).select(*by, "record_number", to_year("text").alias("year"))


def year_histogram(d: DataFrame, lo: int = YEARS[0], hi: int = YEARS[1], by: Sequence[str] = ()) -> DataFrame:
    """(*by, year, n) within lo..hi; rows are counted, so a record with two years counts twice."""
    return record_years(d, by).filter(F.col("year").between(lo, hi)).groupBy(*by, "year").agg(F.count("*").alias("n"))


def records_without(d: DataFrame, keyed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, record_number): records of `d` that `keyed` doesn't have."""
    return d.select(*by, "record_number").distinct().join(keyed.select(*by, "record_number").distinct(), [*by, "record_number"], "left_anti")


def records_without_year(d: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, n): records without any year; 0 where all have one. The range plays no part: a record with a year out of range has
    one. One scan and one exchange by record: whether any of a record's rows carries a year is a plain aggregate."""
    dated = F.coalesce(_carries_year() & digits_only(_year_text()), F.lit(False))
    records = d.select(*by, "record_number", dated.alias("dated")).groupBy(*by, "record_number").agg(F.bool_or("dated").alias("dated"))
    return records.groupBy(*by).agg(F.count_if(~F.col("dated")).alias("n"))
