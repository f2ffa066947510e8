"""Typical values of subfields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .selection import sample_per_group
from .usage import SUBFIELD, value_counts


def example_values(d: DataFrame, k: int = 7, seed: int | str = 1, counts: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(*by, field_code, subfield_code, e_vals): k random distinct values as `value (count)`, joined by a bar.

    Groups can be as large as the dataset; they are cut to k values before the shuffle and before anything is collected.
    """
    counts = value_counts(d, by) if counts is None else counts
    some = sample_per_group(counts, [*by, *SUBFIELD], "value", k, seed).filter("value is not null")  # not before: others share the counts
    shown = some.withColumn("s", F.concat("value", F.lit(" ("), F.col("n").cast("string"), F.lit(")")))
    ordered = F.array_sort(F.collect_list(F.struct("rn", "s")))
    return shown.groupBy(*by, *SUBFIELD).agg(F.concat_ws("|", F.transform(ordered, lambda x: x["s"])).alias("e_vals"))
