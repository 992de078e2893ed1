"""Scans, seeds, key lists and freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factorloom.catalogue import FRESHNESS_DAYS
from factorloom.operators.clean import qualified_only


def scan_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               where: Column | None = None) -> DataFrame:
    """Parquet scan; filter and column list reach the reader."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_seed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header read under a declared schema; a malformed row stops the load."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST",
                          enforceSchema=False)


MACRO_SCHEMA = ("year int, quarter int, absolute_quarter int, risk_free_rate double,"
                " cpi_index double")


def entity_list(spark: SparkSession, mode: str, companies: DataFrame | None = None,
                benchmark: str = "VNINDEX", key: str = "ticker") -> DataFrame:
    """Distinct keys to ingest: every company, the qualified ones, or the index alone."""
    if mode == "benchmark":
        return spark.range(1).select(F.lit(benchmark).alias(key))
    if companies is None:
        raise ValueError(f"mode {mode!r} needs the company table")
    if mode == "all":
        return companies.select(key).distinct()
    if mode == "qualified":
        return qualified_only(companies).select(key).distinct()
    raise ValueError(f"unknown mode {mode!r}")


def freshness(tables: Mapping[str, DataFrame], as_of: datetime,
              limits: Mapping[str, tuple[int, int]] = FRESHNESS_DAYS,
              loaded_at: str = "bronze_ingested_time") -> DataFrame:
    """Newest load time per table against its warn and error limits in days."""
    rows = []
    for name, df in tables.items():
        warn, error = limits[name]
        newest = df.agg(F.max(loaded_at).cast("timestamp").alias("max_loaded_at"))
        age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.lit(as_of))
        rows.append(newest.select(
            F.lit(name).alias("table_name"), "max_loaded_at", age.alias("age_seconds"),
            F.when(age.isNull() | (age > error * 86400), "error")
            .when(age > warn * 86400, "warn").otherwise("pass").alias("status"),
        ))
    return reduce(DataFrame.unionByName, rows)
