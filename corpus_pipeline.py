"""Corpus pipeline: quality, near duplicates, benchmark passages, mixture, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is stored before the next stage reads it.
All stages but the last drop rows and keep the columns of ``documents``; the last gives every row its shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.columns import table
from ledgerloom.llm.cotraining import keep_good
from ledgerloom.llm.minhash import drop_near_duplicates
from ledgerloom.llm.mixing import sample_mix
from ledgerloom.llm.qgrams import decontaminate
from ledgerloom.llm.shards import grid, place
from ledgerloom.runtime import durable

SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least id stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target mixture of sources, languages and topics."""
    return sample_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard and slot."""
    return place(docs, grid(SHARDS))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Minima, co-training and raking go beyond SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
