"""Row rules: reasons per row or their counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from factorloom.catalogue import DIVIDEND, FUNDAMENTAL_QUARTER
from factorloom.operators import quality
from factorloom.operators.dedup import dedup_latest
from factorloom.plans import cleaned
from suite import inputs
from suite.inputs import CTX
from suite.models import models
from suite.registry import query

KEY = ["ticker", "year", "quarter"]
REASON = "unqualified_reason"


def _counts(df, column: str = REASON):
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def _counts_sql(table: str, column: str = REASON) -> str:
    return f"SELECT {column}, count(*) AS n_rows FROM {table} GROUP BY {column}"


def _latest_fq(spark, sf_dir):
    staged = cleaned.stage_fundamental_quarter(inputs.fundamental_quarters(spark, sf_dir), CTX)
    return dedup_latest(staged, KEY, [cleaned.INGESTED])


@query("dq_mandatory", """SELECT ticker, year, quarter, nullif(concat_ws(' | ',
    CASE WHEN market_cap IS NULL THEN 'market_cap is mandatory but null' END,
    CASE WHEN shares_outstanding IS NULL THEN 'shares_outstanding is mandatory but null' END),
    '') AS unqualified_reason FROM x_fq_latest""")
def dq_mandatory(spark, sf_dir):
    rules = quality.mandatory(FUNDAMENTAL_QUARTER, "{} is mandatory but null")
    rows = quality.apply_rules(_latest_fq(spark, sf_dir), rules, with_status=False)
    return rows.select(*KEY, REASON)


@query("dq_non_negative", "SELECT ticker, year, unqualified_reason, status FROM x_div_judged")
def dq_non_negative(spark, sf_dir):
    staged = cleaned.stage_dividends(inputs.dividends_landing(spark, sf_dir), CTX)
    rows = quality.apply_rules(staged, quality.non_negative(DIVIDEND))
    return rows.select("ticker", "year", REASON, "status")


def _statement(key: str, kind: str, source: str) -> None:
    @query(key, f"SELECT ticker, year, quarter, unqualified_reason, status FROM {source}")
    def run(spark, sf_dir):
        wide = cleaned.statement_wide(inputs.reports(spark, sf_dir), kind, CTX)
        rows = quality.apply_rules(wide, quality.statement_rules(kind))
        return rows.select(*KEY, REASON, "status")


_statement("dq_income_statement", "income_statement", "x_is_judged")
_statement("dq_cash_flow", "cash_flow", "x_cf_judged")
_statement("dq_balance_sheet", "balance_sheet", "x_bs_judged")


@query("dq_quotes", """SELECT ticker, unqualified_reason, status, count(*) AS n_rows
    FROM x_quotes_judged GROUP BY ALL""")
def dq_quotes(spark, sf_dir):
    rows = quality.apply_rules(
        inputs.price_days(spark, sf_dir).withColumns({
            c: F.lit(None).cast("double")
            for c in ("price_open", "price_high", "price_low", "total_value")}),
        quality.quote_rules())
    return rows.groupBy("ticker", REASON, "status").agg(F.count(F.lit(1)).alias("n_rows"))


@query("dq_fundamental_2", """SELECT ticker, exchange, is_listing, unqualified_reason, status
    FROM x_fun2_ok""")
def dq_fundamental_2(spark, sf_dir):
    staged = cleaned.stage_fundamental_2(inputs.fundamentals_2(spark, sf_dir))
    return quality.apply_rules(staged, quality.fundamental_2_rules()).drop(cleaned.INGESTED)


@query("dq_fundamental_quarter", """SELECT ticker, year, quarter, unqualified_reason, status
    FROM x_fq_judged""")
def dq_fundamental_quarter(spark, sf_dir):
    rows = quality.apply_rules(_latest_fq(spark, sf_dir), quality.fundamental_quarter_rules())
    return rows.select(*KEY, REASON, "status")


@query("dq_gold_company", "SELECT ticker, gold_unqualified_reason, status FROM x_dim")
def dq_gold_company(spark, sf_dir):
    return models(spark, sf_dir).dim_company().select(
        "ticker", "gold_unqualified_reason", "status")


@query("dq_completeness", _counts_sql("x_panel"))
def dq_completeness(spark, sf_dir):
    return _counts(models(spark, sf_dir).panel())


@query("dq_gap", _counts_sql("x_grow"))
def dq_gap(spark, sf_dir):
    return _counts(models(spark, sf_dir).growth())


@query("dq_min_history", _counts_sql("x_vol"))
def dq_min_history(spark, sf_dir):
    return _counts(models(spark, sf_dir).beta_vol())


@query("dq_staleness", _counts_sql("x_momr"))
def dq_staleness(spark, sf_dir):
    return _counts(models(spark, sf_dir).momentum_recent())


@query("dq_component_nulls", _counts_sql("x_qmj"))
def dq_component_nulls(spark, sf_dir):
    return _counts(models(spark, sf_dir).qmj())


@query("status_resolve", _counts_sql("x_is", "status"))
def status_resolve(spark, sf_dir):
    return _counts(models(spark, sf_dir).statement("income_statement"), "status")
