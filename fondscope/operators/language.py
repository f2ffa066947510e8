"""Languages of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import language_label, marc_language
from ..workspace import bounded_broadcast
from .usage import share_of_total


def language_codes(d: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, record_number, language_code): PICA 010@ $a, and places 36 to 38 of MARC 008 (blanks are a code of their own)."""
    code = F.when(F.col("field_code") == "008", marc_language("value")).otherwise(F.col("value"))
    rows = d.filter(F.col("field_code").isin("008", "010@")).filter((F.col("field_code") == "008") | (F.col("subfield_code") == "a"))
    return rows.select(*by, "record_number", code.alias("language_code"))


def record_languages(d: DataFrame, dim: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, record_number, language): labels `code (Name)`, or the bare code if `dim` (language_code, language) lacks it."""
    names = dim.select("language_code", F.col("language").alias("name")).dropDuplicates(["language_code"])
    codes = language_codes(d, by).join(bounded_broadcast(names, 100), "language_code", "left")
    return codes.select(*by, "record_number", language_label("language_code", "name").alias("language"))


def language_distribution(d: DataFrame, dim: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, language, n, prop), most frequent first; null: records without a language. A record with two counts twice,
    and shares are of all rows so counted."""
    records = d.select(*by, "record_number").distinct()
    rows = records.join(record_languages(d, dim, by), [*by, "record_number"], "left")
    counts = rows.groupBy(*by, "language").agg(F.count("*").alias("n"))
    return share_of_total(counts, "n", by).orderBy(*by, F.desc("n"), "language")
