"""An attribute table derived from the tables of orders and line items, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schema import ATTRIBUTE_SCHEMA
from .workspace import new_path, once

BRANCHES = """
SELECT o_orderkey + 1 AS record_number, 1 AS field_number, 1 AS subfield_number, CASE WHEN o_orderstatus = 'P' THEN '003@' ELSE '001' END AS field_code, CASE WHEN o_orderstatus = 'P' THEN '0' ELSE '' END AS subfield_code, CAST(o_orderkey AS STRING) AS value FROM {orders}
UNION ALL SELECT o_orderkey + 1, 2, 1, '008', '', concat('850101s', CASE WHEN o_orderkey % 10 = 0 THEN '19uu' ELSE CAST(year(o_orderdate) AS STRING) END, rpad('', 24, ' '), CASE o_custkey % 5 WHEN 0 THEN 'eng' WHEN 1 THEN 'ger' WHEN 2 THEN 'fre' WHEN 3 THEN 'fin' ELSE 'zzz' END) FROM {orders} WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey + 1, 2, 1, '011@', 'a', CASE WHEN o_orderkey % 7 = 0 THEN 'n.d.' ELSE CAST(year(o_orderdate) AS STRING) END FROM {orders} WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey + 1, 3, 1, '010@', 'a', 'ger' FROM {orders} WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey + 1, 3, 2, '010@', 'a', 'lat' FROM {orders} WHERE o_orderstatus = 'P' AND o_custkey % 3 = 0
UNION ALL SELECT l_orderkey + 1, 10 + l_linenumber, 1, '700', 'a', CAST(l_partkey AS STRING) FROM {lineitem}
UNION ALL SELECT l_orderkey + 1, 10 + l_linenumber, 2, '700', 'e', l_returnflag FROM {lineitem}
UNION ALL SELECT l_orderkey + 1, 10 + l_linenumber, 3, '700', 'e', l_linestatus FROM {lineitem} WHERE l_linestatus = 'F'
"""
TYPED = f"SELECT CAST(record_number AS BIGINT) AS record_number, CAST(field_number AS INT) AS field_number, CAST(subfield_number AS INT) AS subfield_number, field_code, subfield_code, value FROM ({BRANCHES}) AS branches"
LANGUAGES = "SELECT * FROM (VALUES ('eng', 'English'), ('ger', 'German'), ('fre', 'French'), ('fin', 'Finnish')) AS languages(language_code, language)"
FIELDS = "SELECT * FROM (VALUES ('001', 'Control number', 'https://example.org/001'), ('008', 'Fixed-length data', 'https://example.org/008'), ('700', 'Added entry', 'https://example.org/700'), ('011@', 'Year', NULL), ('010@', 'Language | code', NULL)) AS fields(field_code, field_description, url)"
SUBFIELDS = "SELECT * FROM (VALUES ('700', 'a', 'Name'), ('700', 'e', 'Relation'), ('011@', 'a', 'Year of publication'), ('008', '', 'All of it')) AS subfields(field_code, subfield_code, subfield_description)"

#: The same as common table expressions, for the SQL that results are compared with.
WITH = f"WITH att AS ({TYPED.format(orders='orders', lineitem='lineitem')}), dim AS ({LANGUAGES}), fdesc AS ({FIELDS}), sdesc AS ({SUBFIELDS})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@once
def attributes_path(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "attributes")
    spark.sql(TYPED, orders=table(spark, sf_dir, "orders"), lineitem=table(spark, sf_dir, "lineitem")).write.parquet(path)
    return path


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attribute table, derived once and read from Parquet, as such tables are."""
    return spark.read.schema(ATTRIBUTE_SCHEMA).parquet(attributes_path(spark, sf_dir))


def attributes_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with a `dataset`: the order's status."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey + 1 AS record_number", "o_orderstatus AS dataset")
    return attributes(spark, sf_dir).join(orders, "record_number")


def languages(spark: SparkSession) -> DataFrame:
    return spark.sql(LANGUAGES)


def fields(spark: SparkSession) -> DataFrame:
    return spark.sql(FIELDS)


def subfields(spark: SparkSession) -> DataFrame:
    return spark.sql(SUBFIELDS)
