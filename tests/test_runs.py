"""Scheduled runs over stored landing tables."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from factorloom.catalogue import TableSpec
from factorloom.operators.checks import Check, FailedChecks
from factorloom.plans import cleaned, runs
from factorloom.plans.declared import checks_of
from factorloom.sources.store import Warehouse
from suite import inputs
from suite.inputs import CTX, SECOND_DELIVERY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def content(df, *drop):
    return sorted((tuple(r) for r in df.drop(*drop).select(
        *sorted(c for c in df.columns if c not in drop)).collect()), key=repr)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    store = Warehouse(spark, str(tmp_path_factory.mktemp("store")))
    tables = {
        "company_list": inputs.company_list, "fundamental_1": inputs.fundamentals_1,
        "fundamental_2": inputs.fundamentals_2, "dividend_year": inputs.dividends_landing,
        "fundamental_quarter": inputs.fundamental_quarters,
        "historical_quotes": inputs.quotes_landing, "macro_risk_free_rate": inputs.macro,
    }
    for name, build in tables.items():
        store.replace(build(spark, SF_DIR), TableSpec(name, "", (), ()))
    return store


def lenient(table, ctx):
    """The declared checks as they are, with room for what the test tables break on purpose."""
    return tuple(replace(c, error_over=100_000) for c in checks_of(table, ctx))


def test_two_deliveries_merge_to_the_full_rebuild(spark, landed):
    reports = inputs.reports(spark, SF_DIR)
    late = F.col(cleaned.INGESTED) >= F.lit(SECOND_DELIVERY).cast("timestamp")
    spec = TableSpec("financial_reports_quarter", "", ("year", "data_type"), ())
    runs.refresh_companies(landed, CTX, lenient)
    landed.append(reports.where(~late), spec)
    runs.refresh_reports(landed, CTX, checks_of=lenient)
    first = landed.read("silver_income_statement_quarter")
    before = content(first, "silver_updated_at", "silver_invocation_id", "source_time")
    runs.refresh_reports(landed, CTX, checks_of=lenient)
    again = landed.read("silver_income_statement_quarter")
    assert content(again, "silver_updated_at", "silver_invocation_id", "source_time") == before
    landed.append(reports.where(late), spec)
    runs.refresh_reports(landed, CTX, checks_of=lenient)
    merged = landed.read("silver_income_statement_quarter")
    rebuilt = cleaned.statement(reports, "income_statement", CTX)
    audit = ("silver_updated_at", "silver_invocation_id", "source_time")
    assert content(merged, *audit) == content(rebuilt)
    assert content(merged, *audit) != before


def test_company_and_score_runs(spark, landed, tmp_path):
    dim = runs.refresh_companies(landed, CTX, lenient)
    assert dim.where("status = 'qualified'").count() > 0
    runs.refresh_dividends(landed, CTX)
    later = replace(CTX, started_at=CTX.started_at + timedelta(days=1))
    runs.refresh_companies(landed, later, lenient)
    snapshot = landed.read("dim_company_snapshot")
    assert snapshot.where("valid_to IS NOT NULL").count() == 0
    runs.refresh_prices(landed, CTX, lenient)
    out = str(tmp_path / "site")
    obt = runs.refresh_scores(landed, CTX, lenient, export=out)
    assert "qmj_rank" in obt.columns and "gold_updated_at" in obt.columns
    assert landed.read("int_ttm_metrics").where("ttm_status = 'valid_ttm'").count() > 0
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1 and spark.read.csv(out, header=True).count() == obt.count()


def test_failing_check_stops_a_run_and_publishes_nothing(spark, landed):
    before = runs.refresh_companies(landed, CTX, lenient)
    held = content(before)

    def strict(table, ctx):
        more = (Check("between", ("market_cap",), (10 ** 15, None)),)
        return lenient(table, ctx) + (more if table == "gold_dim_company" else ())

    later = replace(CTX, run_id="later")
    with pytest.raises(FailedChecks, match="between_market_cap"):
        runs.refresh_companies(landed, later, strict)
    assert content(landed.read("gold_dim_company")) == held
    assert landed.read("silver_dim_company").select("silver_invocation_id").distinct().count() == 1
