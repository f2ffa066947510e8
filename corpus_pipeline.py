"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next one:

1. language_id: documents without a language go (no letter, or letter triples that are outliers in the language predicted for the text);
2. line_dedup: lines that match an earlier line go, and documents of which no word is left;
3. ngram_jaccard_join: of each group of near copies the document with the smallest doc_id stays;
4. decontamination: documents that hold a passage of the benchmark go;
5. best_fit_packing: the documents' token ids, packed into sequences.

All but the last return the columns of documents. Filtering stages judge nothing but what their name says, so clean documents pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fondscope.llm import decontamination, language, line_dedup, ngram_join, packing
from fondscope.llm.common import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that have a language stay, as they are. Null texts and texts without a letter go; an empty table stays empty. Rows are judged by
    their text alone, so repeated rows stay or go together, null doc_ids like others; all columns stay."""
    return language.accepted(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that match an earlier line (in order of doc_id, null first, and line); n_chars is counted again. A document of which
    no word is left goes, but a null or empty text that lost nothing stays. Other columns stay; an empty table stays empty."""
    return line_dedup.deduplicated(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the rows of the least doc_id stay, with all of their columns; rows without a doc_id stay. Texts without words are near copies of
    nothing, so they stay; so do the rows of an empty table: none."""
    return ngram_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a passage of the benchmark go, the others stay with all of their columns. Null and empty texts hold none; without
    benchmark rows nothing goes."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of at most 2,048 ids; null texts are empty (one id), repeated rows are packed as often as they occur, and an empty
    table gives no rows."""
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: The stages' classifier, joins and tokenizer have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents of `sf_dir`; what a stage returns is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
