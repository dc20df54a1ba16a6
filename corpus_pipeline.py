"""Cleaning pipeline over ``documents``: quality, boilerplate lines, near duplicates, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again
as the next stage's documents. All but the last return the columns of ``documents``.
Null and empty texts, repeated rows, empty tables and further columns are handled as each
operator's docstring says.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from onlineview.llm import decontaminate, line_dedup, ngram_join, packing, quality_fm
from onlineview.llm.tables import read, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at least 0.7 by the factorisation machine, which is learnt from the whole documents table's labels."""
    return quality_fm.keep(docs, quality_fm.fit(docs, read(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their site's boilerplate lines."""
    return line_dedup.drop_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 on five-word shingles."""
    return ngram_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words inside benchmark windows."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences along the space-filling curve."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_duplicates),
          ("benchmark_decontamination", benchmark), ("packing", pack)]

#: A learnt classifier and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result staged in the shared folder."""
    *first, (_, last) = STAGES
    docs = reduce(lambda d, s: staged(s[1](spark, d, sf_dir), f"pipeline-{s[0]}"), first, read(spark, sf_dir, "documents"))
    return last(spark, docs, sf_dir)
