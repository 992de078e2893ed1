"""Quarterly panel: joined statements and trailing-twelve-month metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.functions.exprs import absolute_quarter
from factorloom.operators import clean, combine, quality
from factorloom.operators.windows import gap, ttm

# Columns the panel takes from each input.
PANEL_COLUMNS = {
    "income_statement": ("gross_revenue", "net_revenue", "cogs", "gross_profit",
                         "interest_expense", "profit_before_tax", "net_income",
                         "net_income_parent"),
    "balance_sheet": ("total_assets", "total_equity", "current_assets", "current_liabilities",
                      "cash_and_equivalents", "income_taxes_payable", "minority_interest",
                      "total_liabilities", "short_term_debt", "long_term_debt",
                      "retained_earnings"),
    "cash_flow": ("cfo", "depreciation", "capex"),
    "fundamental": ("market_cap", "shares_outstanding", "preferred_stock"),
}
# Measures summed over four quarters, point-in-time columns kept as they are.
TTM_MEASURES = (*PANEL_COLUMNS["income_statement"], *PANEL_COLUMNS["cash_flow"])
POINT_IN_TIME = (*PANEL_COLUMNS["balance_sheet"], *PANEL_COLUMNS["fundamental"])
VALID_TTM, BROKEN_TTM = "valid_ttm", "broken_ttm"
KEY = ("ticker", "year", "quarter")
QUARTER = ("ticker", "year", "quarter", "absolute_quarter")
BY_TICKER = ("ticker",)


def financial_panel(income: DataFrame, balance: DataFrame, cash: DataFrame,
                    fundamental: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Qualified statements side by side for qualified companies, with completeness reasons."""
    inputs = {"income_statement": income, "balance_sheet": balance, "cash_flow": cash,
              "fundamental": fundamental}
    allowed = clean.qualified_only(dim_company)
    sides = []
    for name, df in inputs.items():
        # Restricting each side first keeps rows of excluded companies out of the shuffles.
        rows = combine.restrict_to(clean.qualified_only(df), allowed, ["ticker"])
        picked = rows.select(*KEY, *PANEL_COLUMNS[name])
        sides.append(clean.with_presence_flag(picked, f"has_{name}"))
    joined = combine.full_outer_chain(sides, KEY)
    flags = {f"has_{name}": f"missing_{name}" for name in inputs}
    return quality.apply_rules(joined, quality.completeness_rules(flags)).drop(*flags)


def ttm_metrics(panel: DataFrame, macro: DataFrame) -> DataFrame:
    """Four-quarter sums, a continuity verdict and the macro series of the quarter."""
    base = clean.qualified_only(panel).withColumn(
        "absolute_quarter", absolute_quarter("year", "quarter"))
    summed = ttm(base, BY_TICKER, "absolute_quarter", TTM_MEASURES)
    checked = summed.withColumn("quarter_gap", gap("absolute_quarter", BY_TICKER, 3))
    verdict = F.when(F.col("quarter_gap") == 3, VALID_TTM).otherwise(BROKEN_TTM)
    series = macro.select("absolute_quarter", "risk_free_rate", "cpi_index")
    return combine.lookup_left(
        checked.withColumn("ttm_status", verdict), series, "absolute_quarter"
    ).select(
        *QUARTER, *[f"{m}_ttm" for m in TTM_MEASURES], *POINT_IN_TIME,
        "risk_free_rate", "cpi_index", "quarter_gap", "ttm_status",
    )


def valid_ttm(ttm_table: DataFrame) -> DataFrame:
    return ttm_table.where(F.col("ttm_status") == VALID_TTM)


def book_equity() -> Column:
    return F.col("total_equity") - F.col("minority_interest") - F.col("preferred_stock")


def operating_capital() -> Column:
    """Working capital without cash, financing debt and taxes."""
    return (
        F.col("current_assets") - F.col("current_liabilities") - F.col("cash_and_equivalents")
        + F.col("short_term_debt") + F.col("income_taxes_payable")
    )
