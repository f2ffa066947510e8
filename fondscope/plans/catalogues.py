"""All datasets in one job: attribute tables with a `dataset` column, and analyses grouped by it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DATASETS, Dataset, registry
from ..sources import nested, records
from ..sources.attributes import exists, parts_of, read_attributes, write_attributes
from ..sources.dimensions import FIELDS, SUBFIELDS, read_descriptions
from ..sources.inventory import dataset_date, file_inventory, modification_times
from ..workspace import ROWS, scratch
from .composition import composition, years_within

BY = ("dataset",)
#: Spark's setting by which files of shuffles go at the end of their query.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: How the records of each format are read.
READERS = {
    "marcxml": records.read_marcxml,
    "iso2709": records.read_iso2709,
    "picaxml": records.read_picaxml,
    "picapages": lambda spark, path: records.read_picaxml(spark, path, in_pages=True),
    "prefixed": lambda spark, path: records.read_prefixed(records.placed(spark.read.text(path))),
    "documents": nested.read_documents,
}


def ingest(spark: SparkSession, dataset: Dataset, inputs: str, to: str, by_place: bool = False) -> DataFrame:
    """Read a dataset's records from its input files below `inputs`, and write its attribute table to `to`/<dataset>.parquet.
    Records are numbered by file and control number, or `by_place` in the files, which missing and repeated control numbers leave alone. Documents, which are few, are compressed harder, in as few files as their rows ask for. Inputs from which no record comes are an error, not an empty table."""
    with scratch(spark):  # parsed and numbered records aren't needed any more once their rows are written
        read = READERS[dataset.format](spark, f"{inputs}/{dataset.inputs}")
        rows = nested.flatten_documents(read, "_id", "data", by_place=by_place) if dataset.format == "documents" else records.flatten_records(read, None if by_place else ("file", "record_id"))
        if dataset.format == "documents":
            made = write_attributes(rows, f"{to}/{dataset.dataset}.parquet", level=22, tasks=max(1, -(-rows.count() // ROWS)))
        else:
            made = write_attributes(rows, f"{to}/{dataset.dataset}.parquet")
    if made.isEmpty():
        raise ValueError(f"{dataset.dataset}: no {dataset.format} record in {inputs}/{dataset.inputs}")
    return made


def ingest_all(spark: SparkSession, inputs: Iterable[tuple[Dataset, str | Callable[[], str]]], to: str, at_once: int = 3) -> None:
    """`ingest` each dataset from its folder, or from what a function that lands it returns, some beside one another: the last and small tasks
    of one leave cores free for the next. Files of a shuffle go with the write that it was for, not when the driver happens to collect its garbage."""

    def one(dataset: Dataset, folder: str | Callable[[], str]) -> None:
        ingest(spark, dataset, folder if isinstance(folder, str) else folder(), to)

    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        with ThreadPoolExecutor(at_once) as pool:
            for made in [pool.submit(inheritable_thread_target(spark)(one), *x) for x in inputs]:
                made.result()
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def read_datasets(spark: SparkSession, folder: str, datasets: Iterable[str] = tuple(d.dataset for d in DATASETS)) -> DataFrame:
    """The attribute tables of some datasets, one below another, with their keys in `dataset`."""
    tables = [read_attributes(spark, f"{folder}/{k}.parquet").withColumn("dataset", F.lit(k)) for k in datasets]
    return reduce(DataFrame.unionByName, tables)


def years_by_dataset(d: DataFrame, ranges: DataFrame) -> DataFrame:
    """(dataset, year, n) within each dataset's range of `ranges` (dataset, min_year, max_year); a dataset that it lacks has the
    default range."""
    return years_within(d, BY, ranges)


def read_all_descriptions(spark: SparkSession, folder: str, datasets: Iterable[Dataset] = DATASETS) -> tuple[DataFrame, DataFrame]:
    """Descriptions of fields and of subfields for each dataset that names some, from `folder`/<name>_fields.tsv and _subfields.tsv."""
    named = {d.dataset: d.descriptions for d in datasets}

    def all_of(part: str, schema: str) -> DataFrame:
        tables = [read_descriptions(spark, name and f"{folder}/{name}_{part}.tsv", schema).withColumn("dataset", F.lit(k)) for k, name in named.items()]
        return reduce(DataFrame.unionByName, tables)

    return all_of("fields", FIELDS), all_of("subfields", SUBFIELDS)


def dataset_dates(spark: SparkSession, inputs: str, datasets: Iterable[Dataset] = DATASETS) -> DataFrame:
    """(dataset, date) of datasets whose input files lie in `inputs`/<dataset>: the fixed one; else the greatest date that came with one
    of the files that count (in <file>.last_modified), or the newest of these files' own times in UTC; '' if there are none."""

    def of(d: Dataset) -> DataFrame:
        files = f"{inputs}/{d.dataset}/{d.dated or d.inputs}" + (".last_modified" if d.dates == "headers" else "")
        if d.date_modified or not exists(spark, files):
            found = spark.createDataFrame([(d.date_modified or "",)], "date string")
        elif d.dates == "headers":
            found = dataset_date(spark.read.text(files))
        else:
            found = dataset_date(None, modification_times(spark, files))
        return found.select(F.lit(d.dataset).alias("dataset"), "date")

    return reduce(DataFrame.unionByName, (of(d) for d in datasets))


def report(spark: SparkSession, folder: str, descriptions: str, dim: DataFrame, datasets: Iterable[Dataset] = DATASETS, inputs: str | None = None) -> dict[str, DataFrame]:
    """The reports of datasets, whose attribute tables lie in `folder`, in the same jobs: as the registry says, each with its own
    descriptions (from the folder `descriptions`), range of years and, if `inputs` is given, date. `datasets` has their names, `files` the sizes of their parts."""
    datasets = list(datasets)
    d = read_datasets(spark, folder, [x.dataset for x in datasets])
    fdesc, sdesc = read_all_descriptions(spark, descriptions, datasets)
    about = spark.createDataFrame(datasets, registry(spark).schema).select("dataset", "name", "min_year", "max_year")
    names = about.join(dataset_dates(spark, inputs, datasets), "dataset", "left") if inputs else about
    files = reduce(DataFrame.unionByName, (file_inventory(spark, parts_of(spark, f"{folder}/{x.dataset}.parquet")).withColumn("dataset", F.lit(x.dataset)) for x in datasets))
    return {"datasets": names.orderBy("dataset"), "files": files.select("dataset", "file", "bytes", "size").orderBy("dataset", "file"), **composition(d, dim, fdesc, sdesc, by=BY, ranges=about)}
