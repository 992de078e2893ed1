"""The registered queries of the subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factorloom.llm import (
    chats, clusters, decontaminate, impact_index, near_dups, negatives, packing, personal, resample,
    secrets, shards, sql, substrings, url_trust)
from factorloom.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_secret_scan", sql.SECRETS)
def op1(spark, sf_dir):
    return secrets.digest(table(spark, sf_dir, "documents"))


@query("op2_benchmark_decontamination", sql.CONTAMINATION)
def op2(spark, sf_dir):
    return decontaminate.digest(decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query("op3_importance_resampling")
def op3(spark, sf_dir):
    return resample.digest(resample.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query("op4_uniform_shuffle")
def op4(spark, sf_dir):
    return shards.shard_documents(table(spark, sf_dir, "documents"))


@query("op5_best_fit_packing")
def op5(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op6_exact_top_k", sql.TOP_K)
def op6(spark, sf_dir):
    return impact_index.digest(impact_index.top_k(table(spark, sf_dir, "embeddings")))


@query("op7_substring_dedup", sql.SUBSTRINGS)
def op7(spark, sf_dir):
    return substrings.digest(substrings.dedup(
        table(spark, sf_dir, "documents"), with_text=False))


@query("op8_chat_snapshots", sql.CHATS)
def op8(spark, sf_dir):
    return chats.render(table(spark, sf_dir, "conversations"))


@query("op9_url_trust")
def op9(spark, sf_dir):
    return url_trust.digest(url_trust.judge(table(spark, sf_dir, "pages")))


@query("op10_minhash_near_dedup", sql.NEAR_DUPS)
def op10(spark, sf_dir):
    return near_dups.digest(near_dups.link(table(spark, sf_dir, "documents")))


@query("op11_hard_negatives", sql.HARD_NEGATIVES)
def op11(spark, sf_dir):
    return negatives.digest(negatives.hard_negatives(table(spark, sf_dir, "embeddings")))


@query("op12_centroid_clusters", sql.CLUSTERS)
def op12(spark, sf_dir):
    return clusters.digest(clusters.cluster(table(spark, sf_dir, "embeddings")))


@query("op13_personal_data")
def op13(spark, sf_dir):
    return personal.digest(table(spark, sf_dir, "documents"))
