"""Scheduled runs: read landing tables, refresh layer tables, publish the serving table.

Each run works on one ``Warehouse``.  ``refresh_companies`` comes first, since qualified
companies gate the panel; reports and prices may follow in any order; ``refresh_scores``
needs all of them.  ``plans.landing`` fills the landing tables; ``ingest_prices`` is its run
for prices, with the dividend changes that reset watermarks.

Every table is written, checked by what is declared for it (``plans.declared``), and only then
published: a failing check stops the run and leaves the published tables as they were.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.catalogue import STATEMENTS, TableSpec
from factorloom.context import RunContext
from factorloom.operators import clean, incremental
from factorloom.operators.checks import Check
from factorloom.plans import cleaned, declared, factors, landing, panel, scores, serving
from factorloom.sources import tables
from factorloom.sources.store import Warehouse, export_csv

Declared = Callable[[str, RunContext], tuple[Check, ...]]
LOADED = cleaned.INGESTED
SOURCE_TIME = "source_time"

# Columns whose change opens a new company version.
COMPANY_CHECK = ("company_name", "industry_group", "sector_detail", "company_type", "exchange",
                 "is_listing")
DIVIDEND_CHECK = ("cash_dividend", "stock_dividend")


def _table(name: str, *partition_by: str) -> TableSpec:
    return TableSpec(name, "", partition_by, ())


def _parents(store: Warehouse, checks: tuple[Check, ...]) -> dict[str, DataFrame]:
    return {c.values[0]: store.read(c.values[0]) for c in checks if c.kind == "relationship"}


def _replace(store: Warehouse, df: DataFrame, name: str, layer: str, ctx: RunContext,
             checks_of: Declared) -> DataFrame:
    own = checks_of(name, ctx)
    store.replace(clean.with_audit(df, layer, ctx), _table(name), own, _parents(store, own),
                  ctx.started_at)
    return store.read(name)


def _merge_new(store: Warehouse, bronze: DataFrame, build, name: str, keys: list[str],
               ctx: RunContext, checks_of: Declared, whole_keys: bool = False) -> DataFrame:
    """Merge what landed since the last run into a yearly partitioned table.

    The table carries the newest load time it has seen, so rows that land while a run is
    under way are picked up by the next one.  ``whole_keys`` rebuilds touched keys from all
    their landed rows instead of the new ones alone.
    """
    held = store.read_or_none(name)
    fresh = clean.incremental_slice(bronze, held, LOADED, SOURCE_TIME)
    newest = fresh.agg(F.max(LOADED)).scalar()
    rows = incremental.touched_history(bronze, fresh, keys) if whole_keys else fresh
    built = build(rows).withColumn(SOURCE_TIME, newest)
    own = checks_of(name, ctx)
    store.merge(clean.with_audit(built, "silver", ctx), _table(name, "year"), [*keys], own,
                _parents(store, own), ctx.started_at)
    return store.read(name)


def _snapshot(store: Warehouse, current: DataFrame, name: str, keys: tuple[str, ...],
              check: tuple[str, ...], ctx: RunContext, deletes: str) -> DataFrame:
    history = incremental.scd2(store.read_or_none(name), current, keys, check, ctx.started_at,
                               deletes)
    store.replace(history, _table(name))
    return store.read(name)


def refresh_companies(store: Warehouse, ctx: RunContext,
                      checks_of: Declared = declared.checks_of) -> DataFrame:
    """Company master, its qualification and its history."""
    master = _replace(store, cleaned.companies(store.read("company_list"), ctx.ticker_pattern),
                      "silver_dim_company", "silver", ctx, checks_of)
    fun1 = _replace(store, cleaned.fundamental_1(cleaned.stage_fundamental_1(
        store.read("fundamental_1"))), "silver_fundamental_1", "silver", ctx, checks_of)
    fun2 = _replace(store, cleaned.fundamental_2(cleaned.stage_fundamental_2(
        store.read("fundamental_2"))), "silver_fundamental_2", "silver", ctx, checks_of)
    drop = clean.audit_names("silver")
    dim = _replace(store, cleaned.dim_company(
        *(df.drop(*drop) for df in (master, fun1, fun2))), "gold_dim_company", "gold", ctx,
        checks_of)
    current = clean.qualified_only(dim).select("ticker", *COMPANY_CHECK)
    _snapshot(store, current, "dim_company_snapshot", ("ticker",), COMPANY_CHECK, ctx,
              "new_record")
    return dim


def refresh_dividends(store: Warehouse, ctx: RunContext,
                      checks_of: Declared = declared.checks_of) -> DataFrame:
    """Dividends and their history; returns the history."""
    rows = _replace(store, cleaned.dividends(cleaned.stage_dividends(
        store.read("dividend_year"), ctx)), "silver_dividend", "silver", ctx, checks_of)
    current = clean.qualified_only(rows).select("ticker", "year", *DIVIDEND_CHECK)
    return _snapshot(store, current, "dividend_snapshot", ("ticker", "year"), DIVIDEND_CHECK,
                     ctx, "invalidate")


def refresh_reports(store: Warehouse, ctx: RunContext, whole_keys: bool = False,
                    checks_of: Declared = declared.checks_of) -> None:
    """Merge newly landed statements and quarterly market data."""
    landed = store.read("financial_reports_quarter")
    keys = list(cleaned.QUARTER_KEY)
    for kind, form in STATEMENTS.items():
        _merge_new(store, landed.where(F.col("data_type") == form.data_type),
                   lambda rows, k=kind: cleaned.statement(rows, k, ctx),
                   f"silver_{kind}_quarter", keys, ctx, checks_of, whole_keys)
    _merge_new(store, store.read("fundamental_quarter"),
               lambda rows: cleaned.fundamental_quarter(
                   cleaned.stage_fundamental_quarter(rows, ctx)),
               "silver_fundamental_quarter", keys, ctx, checks_of)


def ingest_prices(store: Warehouse, ctx: RunContext, fetch: landing.Fetch, folder: str,
                  retry_fetch: landing.Fetch | None = None) -> DataFrame:
    """Land quotes of the qualified companies and the index.

    Companies whose dividends have changed since the snapshot before ask for their whole
    history again.
    """
    dim = store.read("gold_dim_company")
    keys = tables.entity_list(store.spark, "qualified", dim).unionByName(
        tables.entity_list(store.spark, "benchmark", benchmark=ctx.benchmark))
    history = store.read_or_none("dividend_snapshot")
    changed = None if history is None else incremental.changed_keys(history, ctx.started_at)
    return landing.land(store, landing.FEEDS["historical_quotes"], keys, fetch, ctx, folder,
                        retry_fetch, changed)


def refresh_prices(store: Warehouse, ctx: RunContext,
                   checks_of: Declared = declared.checks_of) -> DataFrame:
    """Merge newly landed quotes."""
    return _merge_new(store, store.read("historical_quotes"),
                      lambda rows: cleaned.quotes(cleaned.stage_quotes(rows, ctx)),
                      "silver_historical_quotes", ["ticker", "date", "year"], ctx, checks_of)


def refresh_scores(store: Warehouse, ctx: RunContext,
                   checks_of: Declared = declared.checks_of,
                   export: str | None = None) -> DataFrame:
    """Panel, factors, scores and the serving table, each step stored for the next.

    With ``export`` the serving table also goes to that folder, as one CSV file for a front end.
    """

    def keep(name: str, df: DataFrame, layer: str = "intermediate") -> DataFrame:
        return _replace(store, df, name, layer, ctx, checks_of).drop(*clean.audit_names(layer))

    dim = store.read("gold_dim_company")
    income, balance, cash, market = (
        store.read(f"silver_{name}_quarter")
        for name in ("income_statement", "balance_sheet", "cash_flow", "fundamental"))
    quotes = store.read("silver_historical_quotes")
    macro = store.read("macro_risk_free_rate")

    ttm = keep("int_ttm_metrics", panel.ttm_metrics(
        panel.financial_panel(income, balance, cash, market, dim), macro))
    bab = keep("int_qmj_beta_final", factors.beta_bab(factors.beta_vol(quotes, ctx)))
    raw = {
        "profitability": factors.profitability(ttm, ctx),
        "growth": factors.growth(ttm, ctx),
        "safety": factors.safety(ttm, bab, factors.altman_z(ttm, ctx),
                                 factors.ohlson_o(ttm, ctx)),
    }
    pillars = []
    for name, df in raw.items():
        components = keep(f"int_qmj_scoring_{name}",
                          scores.score_components(keep(f"int_qmj_{name}", df), name))
        pillars.append(keep(f"gold_qmj_z_{name}", scores.pillar_score(components, name), "gold"))
    qmj = keep("gold_qmj_z_final", scores.qmj_final(*pillars), "gold")
    history = keep("gold_value_and_momentum_z", scores.value_momentum_z(
        factors.value_hist(ttm, ctx), factors.momentum_hist(quotes, ctx)), "gold")
    live = keep("gold_value_and_momentum_z_recent", scores.value_momentum_z_live(
        factors.value_recent(ttm, dim, ctx), factors.momentum_recent(quotes, ctx)), "gold")
    obt = serving.obt_web(qmj, history, live, dim.drop(*clean.audit_names("gold")), market)
    store.swap(clean.with_audit(obt, "gold", ctx), "obt_web", serving.LOOKUP_COLUMNS)
    served = store.read("obt_web")
    if export is not None:
        export_csv(served, export, list(serving.LOOKUP_COLUMNS), single_file=True)
    return served
