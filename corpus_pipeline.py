"""The corpus pipeline: documents that are good, distinct and free of benchmark text, packed into sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet to the shared folder and reads them as the next
one's ``docs``, so that a lost executor never costs more than the running stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phenolens.llm.common import documents, shared_table, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts. Repeated rows are judged alike."""
    from phenolens.llm.quality import accepted
    return accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    from phenolens.llm.exact_dedup import keep_one
    return keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    from phenolens.llm.near_dedup import keep_one
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    from phenolens.llm.decontamination import clean
    return clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    from phenolens.llm.packing import pack_documents
    return pack_documents(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("decontaminate", decontaminate), ("pack", pack)]

#: Compression, tokens and packing can't be written in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
