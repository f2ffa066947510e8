"""How often fields and subfields are used.

`usage_levels` counts all of it in one pass: rows are dealt by record once, and each counts for its record, for its field and for its
pair of codes there. What is asked of a dataset, its fields or subfields are rows of that small table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, floor
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import partitions_for

FIELD, SUBFIELD = ("field_code",), ("field_code", "subfield_code")
#: Levels of `usage_levels`: datasets, fields, subfields.
DATASETS, FIELDS, SUBFIELDS = 0, 1, 2


def _by_record(d: DataFrame, by: Sequence[str], dealt: bool, rows: int | None = None) -> DataFrame:
    """The columns that usage needs, each record's rows in one partition; they are so already if `dealt`, as in a table of
    `write_bucketed`. There are as many partitions as the rows ask for, which are counted unless `rows` (at most so many) is given; so no task's hash
    table grows with the table."""
    base = d.select(*by, "record_number", *SUBFIELD)
    return base if dealt else base.repartition(partitions_for(d.sparkSession, d.count() if rows is None else rows), *by, "record_number")


def record_codes(d: DataFrame, by: Sequence[str] = (), dealt: bool = False) -> DataFrame:
    """(*by, record_number, field_code, subfield_code, n): one exchange by record, which serves every later grouping by record."""
    return _by_record(d, by, dealt).groupBy(*by, "record_number", *SUBFIELD).agg(F.count("*").alias("n"))


def usage_levels(d: DataFrame, by: Sequence[str] = (), dealt: bool = False, rows: int | None = None) -> DataFrame:
    """(*by, level, field_code, subfield_code, records, n, recs_with_mult_vals): how many records have it, its rows, and how many records
    have more than one; a row for each of `by`, for each of its fields and for each of its pairs of codes."""
    unit = lambda level, field, sub: F.struct(F.lit(level).alias("level"), field.alias("field_code"), sub.alias("subfield_code"))
    none, field, sub = F.lit(None).cast("string"), F.col("field_code"), F.col("subfield_code")
    levels = F.inline(F.array(unit(DATASETS, none, none), unit(FIELDS, field, none), unit(SUBFIELDS, field, sub)))
    units = _by_record(d, by, dealt, rows).select(*by, "record_number", levels)
    units = units.groupBy(*by, "record_number", "level", *SUBFIELD).agg(F.count("*").alias("n"))
    counted = F.when(F.col("level") == DATASETS, F.count("record_number")).otherwise(F.count("*"))
    return units.groupBy(*by, "level", *SUBFIELD).agg(counted.alias("records"), F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("recs_with_mult_vals"))


def dataset_totals(d: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, n_records, n_rows): distinct records, and attribute rows."""
    one = d.groupBy(*by, "record_number").agg(F.count("*").alias("n"))
    return one.groupBy(*by).agg(F.count("record_number").alias("n_records"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def totals_of(levels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`dataset_totals` from `usage_levels`; without `by`, one row also for an empty table."""
    whole = levels.filter(F.col("level") == DATASETS)
    return whole.groupBy(*by).agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n_records"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def usage_of(levels: DataFrame, level: int, by: Sequence[str] = ()) -> DataFrame:
    """(*by, codes, records, r_p, n, vals_per_rec, recs_with_mult_vals) of fields or subfields from `usage_levels`. The dataset's row
    stands beside them, so no join is needed for shares."""
    both = levels.filter(F.col("level").isin(DATASETS, level))
    all_records = F.max(F.when(F.col("level") == DATASETS, F.col("records"))).over(Window.partitionBy(*by))
    both = both.withColumn("n_records", all_records).filter(F.col("level") == level)
    return both.select(*by, *(FIELD if level == FIELDS else SUBFIELD), "records", (F.col("records") / F.col("n_records")).alias("r_p"), "n", (F.col("n") / F.col("records")).alias("vals_per_rec"), "recs_with_mult_vals")


def field_usage(d: DataFrame, unit: str = "row", by: Sequence[str] = (), dealt: bool = False, rows: int | None = None) -> DataFrame:
    """(*by, field_code, records, r_p, n, vals_per_rec, recs_with_mult_vals).

    records: that have the field; r_p: their share of all records; n: its rows; recs_with_mult_vals: records with more than one.
    With unit='row' a field of three subfields counts three times; with unit='occurrence' once. `rows`: at most so many, if that is known.
    """
    if unit == "occurrence":
        n = partitions_for(d.sparkSession, d.count() if rows is None else rows)
        d = d.select(*by, "record_number", "field_code", F.lit("").alias("subfield_code"), "field_number")
        d, dealt = (d if dealt else d.repartition(n, *by, "record_number")).distinct(), True  # by record already: no other exchange
    return usage_of(usage_levels(d, by, dealt, rows), FIELDS, by)


def value_counts(d: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, field_code, subfield_code, value, n)."""
    return d.groupBy(*by, *SUBFIELD, "value").agg(F.count("*").alias("n"))


def distinct_values(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, field_code, subfield_code, dist_vals) from value_counts: distinct values that aren't null."""
    return counts.groupBy(*by, *SUBFIELD).agg(F.count("value").alias("dist_vals"))


def subfield_usage(d: DataFrame, counts: DataFrame | None = None, by: Sequence[str] = (), dealt: bool = False) -> DataFrame:
    """As field_usage for pairs of codes, with dist_vals."""
    return with_distinct(usage_of(usage_levels(d, by, dealt), SUBFIELDS, by), value_counts(d, by) if counts is None else counts, by)


def with_distinct(usage: DataFrame, counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Subfield usage with dist_vals; null codes are codes like others. Rows are taken from `counts` too: with all of its columns in use,
    its exchange is the same as that of `example_values`, and done once for both."""
    keys = [*by, *SUBFIELD]
    values = counts.groupBy(*keys).agg(F.count("value").alias("dist_vals"), F.sum("n").alias("_n"))
    return joined(usage, values, keys).select(*(F.col("_n").alias("n") if c == "n" else F.col(c) for c in usage.columns), "dist_vals")


def joined(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which null is a value like others; so no filter of nulls is pushed into either side, and exchanges stay alike."""
    b = b.withColumnsRenamed({k: f"_{k}" for k in keys})
    return a.join(b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], how).drop(*(f"_{k}" for k in keys))


def code_counts(d: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, n_fields, n_subfields): distinct fields, and distinct pairs of codes."""
    pairs = d.groupBy(*by, *SUBFIELD).agg(F.count("*").alias("n"))
    return pairs.groupBy(*by).agg(F.count_distinct("field_code").alias("n_fields"), F.count("*").alias("n_subfields"))


def codes_of(levels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`code_counts` from `usage_levels`."""
    return levels.groupBy(*by).agg(F.count_if((F.col("level") == FIELDS) & F.col("field_code").isNotNull()).alias("n_fields"), F.count_if(F.col("level") == SUBFIELDS).alias("n_subfields"))


def share_of_total(df: DataFrame, col: str, by: Sequence[str] = (), to: str = "prop") -> DataFrame:
    """`df`, a small aggregate, with col's share of its sum (within `by`)."""
    return df.withColumn(to, F.col(col) / F.sum(col).over(Window.partitionBy(*by)))


#: Ranges that a round of `quantiles` counts, and values that its last step may sort.
RANGES, SORTED = 1024, 1 << 20


def _at(lo: float, width: float) -> Column:
    """Which of RANGES equal ranges from `lo` a value lies in."""
    return F.least(F.lit(RANGES - 1), F.greatest(F.lit(0), F.floor((F.col("x") - lo) / width))).cast("int")


def order_statistics(x: DataFrame, ranks: Sequence[int], most: int = SORTED) -> dict[int, float]:
    """The values of `x` (x: double, no nulls) at some ranks from 0 in sorted order.

    Equal ranges of the values are counted, and only those that hold a rank are divided further, until the values left in them are few or
    each holds one value. A round reads the table once and shuffles at most RANGES counts for each open range and task; only these
    counts, and at last at most `most` values and their counts, are looked at together, so no task holds all values.
    """
    inf = float("inf")
    x, finite = x.withColumn("x", F.col("x").cast("double")), F.col("x").between(-1.7976931348623157e308, 1.7976931348623157e308)
    ends = x.agg(F.min(F.when(finite, F.col("x"))).alias("lo"), F.max(F.when(finite, F.col("x"))).alias("hi"), F.count_if(finite).alias("n"), F.count_if(F.col("x") == -inf).alias("below")).first()
    out = {r: -inf if r < ends.below else inf for r in ranks if not ends.below <= r < ends.below + ends.n}
    left = sorted({*ranks} - out.keys())
    open_ = [(ends.lo, ends.hi, ends.below, left, ends.n)] if left else []  # lo, hi (both included), values before, ranks, values
    while open_:
        done = [o for o in open_ if o[0] == o[1]]
        out.update((r, o[0]) for o in done for r in o[3])
        open_ = [o for o in open_ if o[0] < o[1]]
        if not open_:
            break
        inside = reduce(or_, (F.col("x").between(lo, hi) for lo, hi, *_ in open_))
        which = reduce(lambda c, k: c.when(F.col("x").between(open_[k][0], open_[k][1]), F.lit(k)), range(1, len(open_)), F.when(F.col("x").between(open_[0][0], open_[0][1]), F.lit(0)))
        held = x.filter(inside).withColumn("k", which)
        if sum(n for *_, n in open_) <= most:
            counts = held.groupBy("k", "x").agg(F.count("*").alias("n"))
            upto = Window.partitionBy("k").orderBy("x")
            for r in counts.withColumn("upto", F.sum("n").over(upto)).collect():  # at most `most` rows
                before = open_[r.k][2] + r.upto - r.n
                out.update((rank, r.x) for rank in open_[r.k][3] if before <= rank < before + r.n)
            break
        widths = [max(hi / RANGES - lo / RANGES, 5e-324) for lo, hi, *_ in open_]
        at = reduce(lambda c, k: c.when(F.col("k") == k, _at(open_[k][0], widths[k])), range(1, len(open_)), F.when(F.col("k") == 0, _at(open_[0][0], widths[0])))
        bins = held.groupBy("k", at.alias("bin")).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
        open_ = [o for k, old in enumerate(open_) for o in _holding(sorted((b.lo, b.hi, b.n) for b in bins if b.k == k), old[2], old[3])]
    return out


def _holding(bins: list[tuple[float, float, int]], before: int, ranks: Sequence[int]) -> list[tuple[float, float, int, list[int], int]]:
    """The ranges that hold a rank, with what lies before each."""
    out = []
    for lo, hi, n in bins:
        mine = [r for r in ranks if before <= r < before + n]
        out += [(lo, hi, before, mine, n)] if mine else []
        before += n
    return out


def quantiles(df: DataFrame, col: str, shares: Sequence[float], most: int = SORTED) -> list[float | None]:
    """Exact quantiles, interpolated between the two nearest values; nulls and NaN don't count, and of no values there are none."""
    x = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    n = x.count()
    if not n:
        return [None] * len(shares)
    places = [(n - 1) * s for s in shares]
    at = order_statistics(x, [k for p in places for k in (floor(p), ceil(p))], most)
    return [at[floor(p)] if at[floor(p)] == at[ceil(p)] else at[floor(p)] + (at[ceil(p)] - at[floor(p)]) * (p - floor(p)) for p in places]


def quantile_class(df: DataFrame, col: str, classes: int = 8, to: str = "class", most: int = SORTED) -> DataFrame:
    """`df` with the class from 1 of `col`: one more than the number of quantile breaks that it reaches. The breaks are exact, and found
    without any task or buffer that holds all values, so `df` may be as large as a dataset's distinct values."""
    breaks = [b for b in quantiles(df, col, [k / classes for k in range(1, classes)], most) if b is not None]
    reached = sum((F.when(F.col(col) >= b, 1).otherwise(0) for b in breaks), F.lit(0))
    return df.withColumn(to, (1 + reached).cast("int"))


def minmax_scale(df: DataFrame, col: str, to: str = "position") -> DataFrame:
    """`df`, a small aggregate, with where `col` lies between its least (0) and greatest (1) value; null if all are equal."""
    ends = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    out = df.crossJoin(F.broadcast(ends))  # one row
    return out.withColumn(to, F.try_divide(F.col(col) - F.col("_lo"), F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")
