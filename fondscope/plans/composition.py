"""The composition analysis: overviews made of several operators, of one dataset or (with `by`) of many in the same jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import field_link
from ..operators.examples import example_values
from ..operators.language import language_distribution
from ..operators.temporal import record_years, records_without_year
from ..operators.usage import FIELDS, SUBFIELD, SUBFIELDS, codes_of, joined, totals_of, usage_levels, usage_of, value_counts, with_distinct
from ..schema import YEARS
from ..sources.inventory import file_inventory
from ..workspace import bounded_broadcast, written

NO_FIELDS = "field_code string, field_description string, url string"
NO_SUBFIELDS = "field_code string, subfield_code string, subfield_description string"
#: About the bytes of a description, and of a dataset's range of years.
DESCRIPTION_BYTES, RANGE_BYTES = 400, 40


def with_descriptions(usage: DataFrame, desc: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """`usage` with the descriptions of its codes, null where there are none; of repeated descriptions the least is taken. Descriptions
    that have the columns `by` hold for those datasets only, others for all."""
    keys = [*(c for c in by if c in desc.columns), *keys]
    rest = [c for c in desc.columns if c not in keys]
    one = desc.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_d")).select(*keys, *(F.col(f"_d.{c}").alias(c) for c in rest))
    return usage.join(bounded_broadcast(one, DESCRIPTION_BYTES), keys, "left")


def repeated_descriptions(desc: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(dropped): rows that `with_descriptions` leaves out."""
    return desc.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dropped"))


def _fields(levels: DataFrame, desc: DataFrame | None, by: Sequence[str]) -> DataFrame:
    desc = levels.sparkSession.createDataFrame([], NO_FIELDS) if desc is None else desc
    out = with_descriptions(usage_of(levels, FIELDS, by), desc, ["field_code"], by)
    out = out.select(*by, "field_code", "field_description", "records", "r_p", "n", "vals_per_rec", "recs_with_mult_vals", "url", field_link("field_code", "url").alias("field_link"))
    return out.orderBy(*by, "field_code")


def _subfields(d: DataFrame, levels: DataFrame, fdesc: DataFrame | None, sdesc: DataFrame | None, k: int, seed: int | str, by: Sequence[str]) -> DataFrame:
    spark = d.sparkSession
    fdesc = spark.createDataFrame([], NO_FIELDS) if fdesc is None else fdesc
    sdesc = spark.createDataFrame([], NO_SUBFIELDS) if sdesc is None else sdesc
    counts = value_counts(d, by)
    out = joined(with_distinct(usage_of(levels, SUBFIELDS, by), counts, by), example_values(d, k, seed, counts, by), [*by, *SUBFIELD], "left")
    out = with_descriptions(with_descriptions(out, sdesc, SUBFIELD, by), fdesc, ["field_code"], by)
    names = ["field_code", "subfield_code", "subfield_description", "records", "r_p", "dist_vals", "e_vals", "n", "vals_per_rec", "recs_with_mult_vals", "field_description", "url"]
    return out.select(*by, *names).orderBy(*by, *SUBFIELD)


def field_overview(d: DataFrame, desc: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Field usage with descriptions and links, by code."""
    return _fields(usage_levels(d, by), desc, by)


def subfield_overview(d: DataFrame, fdesc: DataFrame | None = None, sdesc: DataFrame | None = None, k: int = 7, seed: int | str = 1, by: Sequence[str] = ()) -> DataFrame:
    """Subfield usage with distinct and typical values and descriptions, by codes. Attribute rows are exchanged twice: by record, and by
    value; values are counted once for both of what is asked of them."""
    return _subfields(d, usage_levels(d, by), fdesc, sdesc, k, seed, by)


def years_within(d: DataFrame, by: Sequence[str] = (), ranges: DataFrame | None = None, lo: int = YEARS[0], hi: int = YEARS[1]) -> DataFrame:
    """(*by, year, n) within lo..hi, or within each dataset's own range of `ranges` (*by, min_year, max_year) if that has one."""
    years = record_years(d, by)
    inside = F.col("year").between(lo, hi)
    if ranges is not None:
        ranges = ranges.select(*by, "min_year", "max_year").dropDuplicates(list(by))
        years = years.join(bounded_broadcast(ranges, RANGE_BYTES), list(by), "left")
        inside = F.col("year").between(F.coalesce("min_year", F.lit(lo)), F.coalesce("max_year", F.lit(hi)))
    return years.filter(inside).groupBy(*by, "year").agg(F.count("*").alias("n"))


def temporal_overview(d: DataFrame, lo: int = YEARS[0], hi: int = YEARS[1], by: Sequence[str] = (), ranges: DataFrame | None = None) -> dict[str, DataFrame]:
    return {"years": years_within(d, by, ranges, lo, hi).orderBy(*by, "year"), "without_year": records_without_year(d, by)}


def composition(
    d: DataFrame, dim: DataFrame, fdesc: DataFrame | None = None, sdesc: DataFrame | None = None, lo: int = YEARS[0], hi: int = YEARS[1], k: int = 7, seed: int | str = 1, path: str | None = None, by: Sequence[str] = (), ranges: DataFrame | None = None, dealt: bool = False
) -> dict[str, DataFrame]:
    """All tables of a report on a dataset, or with `by` on each of many in the same jobs; with its files' sizes if their `path` is given.

    The usage of all levels is counted once and written, a row for each pair of codes; what else is asked of the attribute rows reads
    the table itself, with the columns and fields it needs. Descriptions and `ranges` may have the columns `by`. `dealt`: the table lies by record.
    """
    levels = written(usage_levels(d, by, dealt), "usage")
    files = {"files": file_inventory(d.sparkSession, path)} if path else {}
    return {**files, "totals": totals_of(levels, by), **temporal_overview(d, lo, hi, by, ranges), "languages": language_distribution(d, dim, by), "fields": _fields(levels, fdesc, by), "subfields": _subfields(d, levels, fdesc, sdesc, k, seed, by), "codes": codes_of(levels, by)}
