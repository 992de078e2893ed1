"""Ingestion state and watermarks kept as tables and updated by joins."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.context import RunContext
from factorloom.functions.periods import (
    quarters_to_fetch,
    trading_days_to_fetch,
    years_to_fetch,
)
from factorloom.session import fits

ACTIVE, INACTIVE = "active", "inactive"

# Request paths per task kind, below the source's base address.
URL_PATHS = {
    "fundamental_1": "%1$s/symbols/%2$s/fundamental",
    "fundamental_2": "%1$s/symbols/%2$s",
    "historical_quotes": "%1$s/symbols/%2$s/historical-quotes"
                         "?startDate=%3$s&endDate=%4$s&offset=0&limit=%5$s",
    "quarter_report": "%1$s/symbols/%2$s/full-financial-reports"
                      "?type=%6$s&year=%7$s&quarter=%8$s&limit=%5$s",
    "fundamental_quarter": "%1$s/symbols/%2$s/financial-data"
                           "?type=Q&count=%5$s",
    "year_report": "%1$s/symbols/%2$s/full-financial-reports"
                   "?type=%6$s&year=%7$s&quarter=0&limit=%5$s",
    "dividend": "%1$s/symbols/%2$s/dividends?count=%5$s",
}
# Statement numbers of the report requests.
REPORT_TYPES = {
    "balance_sheet": 1, "income_statement": 2, "cash_flow_direct": 3, "cash_flow_indirect": 4,
}


def expire_state(state: DataFrame, data_type: str, as_of: datetime, hours: int = 24) -> DataFrame:
    """State without the rows of a data type older than ``hours``."""
    old = F.col("created_time") < F.lit(as_of - timedelta(hours=hours))
    return state.where(~((F.col("data_type") == data_type) & old))


def record_state(state: DataFrame, keys: DataFrame, data_type: str, batch_id: str,
                 ctx: RunContext) -> DataFrame:
    """State plus one row per new key; a key already recorded for the type is an error."""
    fresh = keys.select(
        F.lit(batch_id).alias("batch_id"), F.lit(data_type).alias("data_type"), "ticker",
        F.lit(ctx.started_at).alias("created_time"),
    )
    clash = fresh.join(state, ["ticker", "data_type"], "left_semi")
    twice = fresh.groupBy("ticker").count().where("count > 1")
    if not (fits(clash, 0) and fits(twice, 0)):
        raise ValueError(f"{data_type}: some keys are already recorded")
    return state.unionByName(fresh)


def sync_watermark(watermark: DataFrame, reference: DataFrame, data_type: str,
                   fallback: date, changed: DataFrame | None = None) -> DataFrame:
    """Watermark table brought in line with the reference keys.

    New keys start at the fallback date, vanished keys turn inactive, returned keys turn
    active again, and keys in ``changed`` (still referenced) restart at the fallback date,
    also when nothing else differs.  Rows of other data types pass through.
    """
    others = watermark.where(~F.col("data_type").eqNullSafe(data_type))
    held = watermark.where(F.col("data_type") == data_type)
    start = F.lit(fallback).cast("timestamp")
    ref = reference.select("ticker").distinct().withColumn("_ref", F.lit(True))
    joined = held.withColumn("_held", F.lit(True)).join(ref, "ticker", "full")
    if changed is None:
        joined = joined.withColumn("_reset", F.lit(None).cast("boolean"))
    else:
        mark = changed.select("ticker").distinct().withColumn("_reset", F.lit(True))
        joined = joined.join(mark, "ticker", "left")
    referenced = F.col("_ref").isNotNull()
    restart = F.col("_held").isNull() | (referenced & F.col("_reset").isNotNull())
    synced = joined.select(
        "ticker",
        F.lit(data_type).alias("data_type"),
        F.when(referenced, F.lit(ACTIVE)).otherwise(F.lit(INACTIVE)).alias("ticker_status"),
        F.when(restart, start).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    return others.unionByName(synced)


def reconcile_watermark(watermark: DataFrame, data: DataFrame | None, data_type: str,
                        as_of: date, years: int = 3) -> DataFrame:
    """Watermark rebuilt from the newest ingest time per key in the stored data.

    Only the last ``years`` report years are read.  Without any data the rows of the data
    type are dropped, so that the next run starts from scratch.
    """
    others = watermark.where(~F.col("data_type").eqNullSafe(data_type))
    if data is None:
        return others
    held = watermark.where(F.col("data_type") == data_type)
    recent = (F.col("year") >= as_of.year - years) & (F.col("data_type") == data_type)
    seen = data.where(recent).groupBy("ticker").agg(
        F.max("bronze_ingested_time").alias("_seen"))
    any_data = seen.agg(F.count(F.lit(1)) > 0).scalar()
    joined = held.join(seen, "ticker", "left").where(any_data)
    rebuilt = joined.withColumn(
        "updated_at", F.coalesce("_seen", "updated_at")).drop("_seen")
    return others.unionByName(rebuilt)


def start_dates(watermark: DataFrame, data_type: str) -> DataFrame:
    """Active keys of a data type with the day their next fetch starts."""
    rows = (F.col("data_type") == data_type) & (F.col("ticker_status") == ACTIVE)
    return watermark.where(rows).select("ticker", F.to_date("updated_at").alias("start_date"))


def _limit(kind: str, day: Column) -> Column:
    if kind in ("quarter_report", "fundamental_quarter"):
        return quarters_to_fetch("start_date", day)
    if kind == "year_report":
        return years_to_fetch("start_date", day)
    if kind == "dividend":
        return (F.year(day) - F.year("start_date") + 1).cast("bigint")
    if kind == "historical_quotes":
        return trading_days_to_fetch("start_date", day)
    if kind in ("fundamental_1", "fundamental_2"):
        return F.lit(1).cast("bigint")
    raise ValueError(f"unknown task kind {kind!r}")


def plan_tasks(starts: DataFrame, kind: str, data_type: str, ctx: RunContext,
               source: str = "source", report: str | None = None,
               base_url: str = "https://api.example.com") -> DataFrame:
    """Request rows for every key whose period to fetch is not empty.

    ``starts`` has ``ticker`` and ``start_date``; the result has the columns of a request
    message plus the computed ``fetch_limit``.
    """
    day = F.lit(ctx.today)
    quarter_of = (ctx.today.month + 2) // 3
    year, quarter = ctx.today.year, quarter_of - 1
    if kind == "year_report" or quarter == 0:
        year, quarter = year - 1, 4
    rows = starts.withColumn("fetch_limit", _limit(kind, day)).where(F.col("fetch_limit") > 0)
    end = F.date_sub(day, 1)
    parts = [
        F.lit(base_url), F.col("ticker"), F.col("start_date").cast("string"), end.cast("string"),
        F.col("fetch_limit").cast("string"),
        F.lit(str(REPORT_TYPES.get(report, 0))), F.lit(str(year)), F.lit(str(quarter)),
    ]
    return rows.select(
        "ticker", F.lit(ctx.run_id).alias("batch_id"), F.lit(data_type).alias("data_type"),
        F.lit(source).alias("source"), F.lit(ctx.started_at.isoformat()).alias("created_at_ts"),
        F.format_string(URL_PATHS[kind], *parts).alias("url"), "fetch_limit",
    )
