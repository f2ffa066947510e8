"""The attribute table's schema, and the datasets whose catalogues are analysed."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

#: One row for each (sub)field value of a record.
ATTRIBUTE_SCHEMA = T.StructType(
    [
        T.StructField("record_number", T.LongType()),
        T.StructField("field_number", T.IntegerType()),
        T.StructField("subfield_number", T.IntegerType()),
        T.StructField("field_code", T.StringType()),
        T.StructField("subfield_code", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
ORDINALS = ("record_number", "field_number", "subfield_number")
CODES = ("field_code", "subfield_code")

#: Years that the temporal analysis covers when a dataset has no range of its own.
YEARS = (1000, 2050)


class Dataset(NamedTuple):
    dataset: str
    name: str
    format: str
    inputs: str
    descriptions: str | None = "marc"
    min_year: int = YEARS[0]
    max_year: int = YEARS[1]
    date_modified: str | None = None
    dates: str = "headers"  # what dates it if it has no fixed date: the dates that came with its files, or the files' own times
    dated: str | None = None  # the files that count for this, if not all inputs


# The datasets and their parameters.
DATASETS = (
    Dataset("cnb", "Czech National Bibliography", "marcxml", "*.xml.gz"),
    Dataset("dnb", "German National Bibliography", "marcxml", "*.mrc.xml.gz", dated="dnb_all_dnbmarc.1.mrc.xml.gz"),
    Dataset("erb", "Estonian National Bibliography", "marcxml", "*.mrcx.gz", dates="times"),
    Dataset("estc", "English Short Title Catalogue", "marcxml", "*.xml.gz", "marc", 1400, 1800, "2020-09"),
    Dataset("fennica", "Fennica", "marcxml", "*.mrcx.zst", dates="times"),
    Dataset("gnd", "German Integrated Authority File", "marcxml", "*.mrc.xml.gz", dated="authorities-gnd-*.mrc.xml.gz"),
    Dataset("hpb", "Heritage of the Printed Book", "picaxml", "*.mrcx.gz", "pica", 1400, 1800, "2025-03"),
    Dataset("istc", "Incunabula Short Title Catalogue", "documents", "*.jsonl", "k10_pica"),
    Dataset("plnb", "Polish National Bibliography", "iso2709", "*.marc"),
    Dataset("ptnb", "Portuguese National Bibliography", "marcxml", "*.xml", None),
    Dataset("vd17", "VD17", "picapages", "*.xml.gz", "k10_pica", 1601, 1700, dates="times"),
    Dataset("vd18", "VD18", "picapages", "*.xml.gz", "k10_pica", 1701, 1800, dates="times"),
    Dataset("viaf", "Virtual International Authority File", "prefixed", "*.xml.gz", "marc", *YEARS, "2024-08-04"),
)
# End of the fixed values.


def registry(spark):
    """The datasets as a table."""
    return spark.createDataFrame(DATASETS, "dataset string, name string, format string, inputs string, descriptions string, min_year int, max_year int, date_modified string, dates string, dated string")
