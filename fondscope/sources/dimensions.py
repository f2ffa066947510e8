"""Descriptions and language names, from delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIELDS = "field_code string, field_description string, url string"
SUBFIELDS = "field_code string, subfield_code string, subfield_description string"
LANGUAGES = "language_code string, language string"


def read_descriptions(spark: SparkSession, path: str | None, schema: str = FIELDS) -> DataFrame:
    """A tab-separated table with a header; an empty one if there is no file. `NA` is null, an empty description too,
    but an empty subfield code is the empty string that attribute rows have."""
    if not path:
        return spark.createDataFrame([], schema)
    read = spark.read.option("sep", "\t").option("header", True).option("nullValue", "NA").option("quote", "")
    df = read.schema(schema).csv(path)
    return df.fillna("", ["subfield_code"]) if "subfield_code" in df.columns else df


def read_languages(spark: SparkSession, path: str) -> DataFrame:
    """Language codes and names, comma-separated with a header."""
    return spark.read.option("header", True).schema(LANGUAGES).csv(path)
