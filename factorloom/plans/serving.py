"""The wide serving table and its publication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.operators import clean, combine
from factorloom.operators.ranking import xs_rank
from factorloom.plans.panel import QUARTER
from factorloom.plans.scores import BY_QUARTER

# Rounded output columns (output -> score) and lookup columns of the table.
ROUNDED = {
    "qmj_profitability": "qmj_profitability_score",
    "qmj_growth": "qmj_growth_score",
    "qmj_safety": "qmj_safety_score",
    "qmj_score": "qmj_score",
    "z_value_historical": "z_value",
    "z_momentum_historical": "z_momentum",
    "value_raw_score": "value_raw_score",
    "momentum_raw_score": "momentum_raw_score",
    "value_recent_score": "value_recent_score",
    "momentum_recent_score": "momentum_recent",
    "z_value_recent": "z_value_recent",
    "z_momentum_recent": "z_momentum_recent",
}
LOOKUP_COLUMNS = ("year", "quarter", "qmj_rank", "ticker", "z_value_recent",
                  "z_momentum_recent")
COMPANY_COLUMNS = {
    "company_name": "company_name", "exchange": "exchange", "sector_detail": "sector_detail",
    "industry_group": "industry_group", "current_market_cap": "market_cap",
    "avg_volume_3m": "avg_volume_3m", "current_shares_outstanding": "shares_outstanding",
}
QUARTER_COLUMNS = {"quarter_market_cap": "market_cap",
                   "quarter_shares_outstanding": "shares_outstanding"}


def _pick(df: DataFrame, keys, names: dict[str, str]) -> DataFrame:
    return df.select(*keys, *[F.col(src).alias(out) for out, src in names.items()])


def obt_web(qmj: DataFrame, value_momentum: DataFrame, live: DataFrame, dim_company: DataFrame,
            fundamental_quarter: DataFrame) -> DataFrame:
    """One wide row per scored company and quarter."""
    ok = clean.qualified_only
    ranked = xs_rank(ok(qmj), BY_QUARTER, {"qmj_rank": "qmj_score"}, descending=True,
                     nullable=False).drop("status", "unqualified_reason")
    history = ok(value_momentum).drop("status", "unqualified_reason")
    recent = ok(live).drop("status", "unqualified_reason")
    company = _pick(ok(dim_company), ["ticker"], COMPANY_COLUMNS)
    market = _pick(ok(fundamental_quarter), QUARTER[:3], QUARTER_COLUMNS)
    wide = combine.assemble(ranked, [
        (history, QUARTER, "left"),
        (company, ["ticker"], "inner"),
        (market, QUARTER[:3], "left"),
        (recent, ["ticker"], "left"),
    ])
    return clean.round_outputs(wide, ROUNDED).select(
        "ticker", "company_name", "exchange", "sector_detail", "industry_group", "year",
        "quarter", "absolute_quarter", "current_market_cap", "avg_volume_3m",
        "current_shares_outstanding", *QUARTER_COLUMNS, "qmj_profitability", "qmj_growth",
        "qmj_safety", "qmj_score", "qmj_rank", *list(ROUNDED)[4:])


def in_report_order(obt: DataFrame) -> DataFrame:
    return obt.orderBy(F.desc("absolute_quarter"), "qmj_rank")
