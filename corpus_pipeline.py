"""A training-data pipeline over ``documents``: each stage takes what the one before kept.

All stages but the last return the columns of ``documents``; the last one returns the packed
sequences.

Null, empty and very long texts, repeated ids and rows, ties, empty tables and extra columns of any
name have the results that the modules of the operators state; a stage keeps all columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factorloom.llm import decontaminate, near_dups, packing, resample, secrets
from factorloom.llm.frames import stored
from factorloom.session import prepare


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance; the cut is that of the documents in ``labels``."""
    return resample.keep_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dups.thin(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no notable part of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.redact(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: texts, whose pieces they are and where these begin, room left."""
    return packing.sequences(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("sequence_packing", sequence_packing),
]

# The first stage draws at random from hashed models; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
