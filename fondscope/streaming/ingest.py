"""New harvest files as a stream of attribute tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ATTRIBUTE_SCHEMA


def attribute_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Attribute rows of Parquet files as they land in `folder`."""
    return spark.readStream.schema(ATTRIBUTE_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def usage_stream(d: DataFrame) -> DataFrame:
    """Running rows of each pair of codes: state is a row for each pair, however many records arrive."""
    return d.groupBy("field_code", "subfield_code").agg(F.count("*").alias("n"))


def newest_versions(records: DataFrame, key: str = "record_id", stamp: str = "datestamp") -> DataFrame:
    """Of records harvested more than once, the newest of each: what an upsert of a harvest window keeps."""
    best = records.groupBy(key).agg(F.max_by(F.struct(*records.columns), F.struct(F.col(stamp))).alias("r"))
    return best.select("r.*")
