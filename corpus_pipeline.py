"""Corpus pipeline: quality, near duplicates, decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import read
from quarry.llm.decontaminate import keep_clean
from quarry.llm.mixing import mixed_documents
from quarry.llm.near_dup import keep_one
from quarry.llm.quality import keep_good
from quarry.llm.sharding import shard_documents
from quarry.session import cut_lineage, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.7)."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at similarity 0.8."""
    return keep_one(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_documents(docs, place=False)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix; repeats of a document are equal texts and stay together."""
    return shard_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

ORACLE_SQL = None        # the classifier and the mix's draw are not SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = read(spark, sf_dir, "documents")
    with scratch(spark, "pipeline") as folder:
        for name, stage in STAGES[:-1]:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
        return cut_lineage(STAGES[-1][1](spark, docs, sf_dir))
