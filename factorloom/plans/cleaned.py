"""Landing tables to typed, deduplicated, rule-checked tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.catalogue import (
    DIVIDEND,
    FUNDAMENTAL_1,
    FUNDAMENTAL_2,
    FUNDAMENTAL_QUARTER,
    HISTORICAL_QUOTES,
    STATEMENTS,
    Indicator,
)
from factorloom.context import RunContext
from factorloom.functions.exprs import catalogue_text
from factorloom.operators import clean, combine, quality
from factorloom.operators.aggregates import pivot_eav
from factorloom.operators.dedup import dedup_first, dedup_latest

INGESTED = "bronze_ingested_time"
QUARTER_KEY = ("ticker", "year", "quarter")


def _zeros(indicators: Sequence[Indicator]) -> dict[str, object]:
    return {i.alias: 0 for i in indicators}


# Typing ------------------------------------------------------------------------------------

def stage_quotes(bronze: DataFrame, ctx: RunContext, target: DataFrame | None = None) -> DataFrame:
    """Quote documents newer than the target, typed; years before the minimum are left out."""
    rows = clean.incremental_slice(bronze, target, INGESTED).where(
        F.col("year") >= ctx.min_year)
    keep = [F.col("ticker").cast("string"), F.col("event_date").try_cast("date").alias("date"),
            INGESTED]
    return clean.extract_fields(rows, "data", HISTORICAL_QUOTES, keep)


def stage_fundamental_quarter(bronze: DataFrame, ctx: RunContext,
                              target: DataFrame | None = None) -> DataFrame:
    rows = clean.incremental_slice(bronze, target, INGESTED).where(
        F.col("year") >= ctx.min_year)
    keep = ["ticker", F.col("year").cast("int"), F.col("quarter").cast("int"), INGESTED]
    return clean.extract_fields(rows, "value", FUNDAMENTAL_QUARTER, keep)


def _stage_recent(bronze: DataFrame, indicators: Sequence[Indicator], keep: list) -> DataFrame:
    rows = clean.recent_slice(bronze, INGESTED)
    ticker = catalogue_text("ticker").alias("ticker")
    return clean.extract_fields(rows, "data", indicators, [ticker, *keep, INGESTED])


def stage_fundamental_1(bronze: DataFrame) -> DataFrame:
    return _stage_recent(bronze, FUNDAMENTAL_1, [])


def stage_fundamental_2(bronze: DataFrame) -> DataFrame:
    return _stage_recent(bronze, FUNDAMENTAL_2, [])


def stage_dividends(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _stage_recent(bronze, DIVIDEND, ["year"])
    return rows.where(F.col("year") >= ctx.min_year)


# Checking ----------------------------------------------------------------------------------

def latest_cells(bronze: DataFrame, kind: str, ctx: RunContext) -> DataFrame:
    """Newest value per entity, quarter and indicator of one statement.

    On the landing table the first two conditions prune partitions; the third keeps
    indicators no catalogue names out of the shuffle.
    """
    form = STATEMENTS[kind]
    rows = bronze.where(
        (F.col("data_type") == form.data_type) & (F.col("year") >= ctx.min_year)
        & F.col("indicator_id").isin([int(i.source) for i in form.indicators])
    ).select(*QUARTER_KEY, "indicator_id", "value", INGESTED)
    return dedup_latest(rows, [*QUARTER_KEY, "indicator_id"], [INGESTED])


def statement_wide(bronze: DataFrame, kind: str, ctx: RunContext) -> DataFrame:
    """One row per entity and quarter.

    The newest values come spread by indicator too, so adding up before the shuffle would send a
    wide row for nearly every value.  They are at most one per indicator: they move as they are.
    """
    form = STATEMENTS[kind]
    values = latest_cells(bronze, kind, ctx).repartition(*QUARTER_KEY)
    return pivot_eav(values, QUARTER_KEY, form.indicators)


def statement(bronze: DataFrame, kind: str, ctx: RunContext) -> DataFrame:
    """One row per entity and quarter with the statement's columns, status and reasons.

    Rules see the delivered values; only then do missing values become 0.
    """
    checked = quality.apply_rules(statement_wide(bronze, kind, ctx), quality.statement_rules(kind))
    return clean.fill_defaults(checked, _zeros(STATEMENTS[kind].indicators))


def quotes(staged: DataFrame) -> DataFrame:
    """One row per entity and day with calendar counters, status and reasons."""
    latest = dedup_latest(staged, ["ticker", "date"], [INGESTED])
    checked = quality.apply_rules(latest, quality.quote_rules())
    filled = clean.fill_defaults(checked, _zeros(HISTORICAL_QUOTES))
    return clean.with_period_index(filled, "date").drop(INGESTED)


def fundamental_quarter(staged: DataFrame) -> DataFrame:
    latest = dedup_latest(staged, list(QUARTER_KEY), [INGESTED]).drop(INGESTED)
    checked = quality.apply_rules(latest, quality.fundamental_quarter_rules())
    return clean.fill_defaults(checked, _zeros(FUNDAMENTAL_QUARTER))


def fundamental_1(staged: DataFrame) -> DataFrame:
    latest = dedup_latest(staged, ["ticker"], [INGESTED]).drop(INGESTED)
    return quality.apply_rules(latest, quality.fundamental_1_rules())


def fundamental_2(staged: DataFrame) -> DataFrame:
    latest = dedup_latest(staged, ["ticker"], [INGESTED]).drop(INGESTED)
    return quality.apply_rules(latest, quality.fundamental_2_rules())


def dividends(staged: DataFrame) -> DataFrame:
    latest = dedup_latest(staged, ["ticker", "year"], [INGESTED]).drop(INGESTED)
    checked = quality.apply_rules(latest, quality.dividend_rules())
    return clean.fill_defaults(checked, _zeros(DIVIDEND))


# Company master ----------------------------------------------------------------------------

# Texts for unnamed companies.
COMPANY_DEFAULTS = {
    "company_name": "Unknown Company",
    "industry_group": "Unclassified",
    "sector_detail": "Unclassified",
}


def companies(bronze: DataFrame, pattern: str = clean.TICKER_PATTERN) -> DataFrame:
    """One row per ticker of the given form, the first by name winning among repeats."""
    valid = clean.regex_filter(bronze, "ticker", pattern, not_null=["company_type"])
    first = dedup_first(valid, ["ticker"], ["company_name", "industry_group", "sector_detail"])
    return clean.fill_defaults(first, COMPANY_DEFAULTS).select(
        "ticker", *COMPANY_DEFAULTS, "company_type")


def _tagged(df: DataFrame, prefix: str) -> DataFrame:
    """Status columns under a prefix, plus a copy of the key that marks presence."""
    return df.withColumnsRenamed(
        {c: f"{prefix}_{c}" for c in ("status", "unqualified_reason")}
    ).withColumn(f"{prefix}_ticker", F.col("ticker"))


def dim_company(master: DataFrame, fun1: DataFrame, fun2: DataFrame,
                min_market_cap: float = quality.MIN_MARKET_CAP,
                min_avg_volume: float = quality.MIN_AVG_VOLUME) -> DataFrame:
    """Company master with both fundamental feeds and the screening rules."""
    joined = combine.left_dims(master, [_tagged(fun1, "fun1"), _tagged(fun2, "fun2")], ["ticker"])
    checked = quality.apply_rules(
        joined, quality.company_rules(min_market_cap, min_avg_volume), "gold_unqualified_reason")
    helpers = [f"{p}_{c}" for p in ("fun1", "fun2")
               for c in ("status", "unqualified_reason", "ticker")]
    return checked.drop(*helpers)
