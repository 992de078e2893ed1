"""Raw factor values per entity and quarter.

Every window here runs over one entity's quarters or days, one row each (see
``operators.windows``), so its size is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.context import RunContext
from factorloom.functions.exprs import positive_ln, ratio, strict_greatest
from factorloom.operators import clean, combine, quality
from factorloom.operators.dedup import last_in_period, latest_per_key
from factorloom.operators.windows import (
    gap,
    gap_lag,
    multi_lag,
    rolling_corr,
    rolling_stddev,
    rolling_sum,
)
from factorloom.plans.panel import (
    BY_TICKER,
    QUARTER,
    book_equity,
    operating_capital,
    valid_ttm,
)

INDEX = "absolute_quarter"

# Weights of the five solvency ratios.
Z_WEIGHTS = {"x1_wc_at": 1.2, "x2_re_at": 1.4, "x3_ebit_at": 3.3, "x4_me_at": 0.6,
             "x5_sale_at": 1.0}
# Intercept and coefficients of the default-risk sum.
O_INTERCEPT = -1.32
O_WEIGHTS = {"log_size": -0.407, "tlta": 6.03, "wcta": -1.43, "clca": 0.076, "oeneg": -1.72,
             "nita": -2.37, "futl": -1.83, "intwo": 0.285, "chin": -0.521}
# Trading rows per year and four years, minimum rows, shrinkage of beta.
YEAR_ROWS, CORR_ROWS, MIN_VOL_ROWS, MIN_CORR_ROWS = 252, 1008, 120, 750
BETA_WEIGHT, BETA_PRIOR = 0.6, 0.4
# Quarters of the earnings window, lags of momentum, freshness limits.
EVOL_QUARTERS, MIN_EVOL_QUARTERS = 16, 12
MONTH_ROWS = 21
MAX_AGE_DAYS, MAX_DELAY_QUARTERS = 10, 2


def _weighted(weights: dict[str, float], start: float = 0.0):
    total = F.lit(start)
    for name, weight in weights.items():
        total = total + F.lit(weight) * F.col(name).cast("double")
    return total


def profitability(ttm: DataFrame, ctx: RunContext) -> DataFrame:
    """Six return measures; accruals use the four-quarter change of working capital."""
    base = valid_ttm(ttm).withColumns({"book_equity": book_equity(),
                                       "working_capital": operating_capital()})
    base = gap_lag(base, BY_TICKER, INDEX, {"_wc_past": "working_capital"}, 4, "quarter_gap_wc")
    change = F.col("working_capital") - F.col("_wc_past")
    accrual = F.col("depreciation_ttm") - change

    def over(num, den):
        return ratio(num, den, ctx.ratio_mode)

    measures = {
        "gpoa": over("gross_profit_ttm", "total_assets"),
        "roe": over("net_income_parent_ttm", "book_equity"),
        "roa": over("net_income_ttm", "total_assets"),
        "gmar": over("gross_profit_ttm", "net_revenue_ttm"),
        "cfoa": over(F.col("net_income_ttm") + accrual - F.col("capex_ttm"), "total_assets"),
        "acc": over(accrual, "total_assets"),
    }
    rules = [
        quality.gap_rule("quarter_gap_wc", 4,
                         "Err: Missing historical quarters for Delta WC (Gap != 4)"),
        *quality.component_null_rules(list(measures)),
    ]
    rows = quality.apply_rules(base.withColumns(measures), rules)
    return rows.select(*QUARTER, *measures, "status", "unqualified_reason")


def growth(ttm: DataFrame, ctx: RunContext) -> DataFrame:
    """Three-year change of income above the risk-free return on the previous year's base."""
    base = valid_ttm(ttm).withColumns({"book_equity": book_equity(),
                                       "working_capital": operating_capital()})
    base = multi_lag(base, BY_TICKER, INDEX, {"_wc_past": ("working_capital", 4)})
    base = base.withColumn(
        "cash_income_ttm",
        F.col("net_income_ttm") + F.col("depreciation_ttm")
        - (F.col("working_capital") - F.col("_wc_past")) - F.col("capex_ttm"),
    )
    plan = {}
    for name in ("total_assets", "book_equity"):
        plan |= {f"{name}_1y": (name, 4), f"{name}_3y": (name, 12), f"{name}_4y": (name, 16)}
    for name in ("gross_profit_ttm", "net_income_parent_ttm", "net_income_ttm",
                 "cash_income_ttm", "net_revenue_ttm", "risk_free_rate"):
        plan[f"{name}_3y"] = (name, 12)
    base = multi_lag(base, BY_TICKER, INDEX, plan)
    base = base.withColumn("quarter_gap_16", gap(INDEX, BY_TICKER, 16))

    def residual(income: str, rate: str, base_col: str):
        hurdle = F.col(rate) / 100 * F.col(base_col).cast("double")
        return F.col(income).cast("double") - hurdle

    def change(income: str, base_col: str):
        now = residual(income, "risk_free_rate", f"{base_col}_1y")
        past = residual(f"{income}_3y", "risk_free_rate_3y", f"{base_col}_4y")
        return ratio(now - past, f"{base_col}_3y", ctx.ratio_mode)

    measures = {
        "delta_gpoa": change("gross_profit_ttm", "total_assets"),
        "delta_roe": change("net_income_parent_ttm", "book_equity"),
        "delta_roa": change("net_income_ttm", "total_assets"),
        "delta_cfoa": change("cash_income_ttm", "total_assets"),
        "delta_gmar": ratio(F.col("gross_profit_ttm") - F.col("gross_profit_ttm_3y"),
                            "net_revenue_ttm_3y", ctx.ratio_mode),
    }
    rules = [
        quality.gap_rule("quarter_gap_16", 16, "Err: Broken history for Growth (Gap != 16)"),
        *quality.component_null_rules(list(measures)),
    ]
    rows = quality.apply_rules(base.withColumns(measures), rules)
    return rows.select(*QUARTER, *measures, "status", "unqualified_reason")


def altman_z(ttm: DataFrame, ctx: RunContext) -> DataFrame:
    """Solvency score: weighted sum of five ratios to total assets."""
    base = valid_ttm(ttm).withColumns({
        "working_capital": F.col("current_assets") - F.col("current_liabilities"),
        "ebit_ttm": F.col("profit_before_tax_ttm") + F.col("interest_expense_ttm"),
    })
    tops = dict(zip(Z_WEIGHTS, ("working_capital", "retained_earnings", "ebit_ttm",
                                "market_cap", "net_revenue_ttm")))
    scored = base.withColumns(
        {x: ratio(top, "total_assets", ctx.ratio_mode) for x, top in tops.items()}
    ).withColumn("altman_z_score", _weighted(Z_WEIGHTS))
    labels = {"working_capital": "wc", "retained_earnings": "re", "ebit_ttm": "ebit",
              "market_cap": "market_cap", "net_revenue_ttm": "revenue"}
    rules = [(f"{c} IS NULL", f"{label} is null") for c, label in labels.items()]
    return quality.apply_rules(scored, rules).select(
        *QUARTER, *Z_WEIGHTS, "altman_z_score", "status", "unqualified_reason")


def ohlson_o(ttm: DataFrame, ctx: RunContext) -> DataFrame:
    """Negated default-risk sum, so that a higher score is safer.

    The logarithm of a non-positive size is NULL and disqualifies the row.
    """
    base = valid_ttm(ttm).withColumns({
        "adj_asset": F.col("total_assets").cast("double")
        + 0.1 * (F.col("market_cap") - book_equity()).cast("double"),
        "total_debt": F.col("short_term_debt") + F.col("long_term_debt"),
    })
    base = gap_lag(base, BY_TICKER, INDEX, {"net_income_past": "net_income_ttm"}, 4,
                   "quarter_gap_4")
    mode = ctx.ratio_mode
    now, past = F.col("net_income_ttm"), F.col("net_income_past")
    short = F.col("current_assets") - F.col("current_liabilities")
    variables = {
        "log_size": positive_ln(ratio("adj_asset", "cpi_index", mode)),
        "tlta": ratio("total_debt", "adj_asset", mode),
        "wcta": ratio(short, "adj_asset", mode),
        "clca": ratio("current_liabilities", "current_assets", mode),
        "oeneg": F.when(F.col("total_liabilities") > F.col("total_assets"), 1).otherwise(0),
        "nita": ratio("net_income_ttm", "total_assets", mode),
        "futl": ratio("profit_before_tax_ttm", "total_liabilities", mode),
        "intwo": F.when(strict_greatest(now, past) < 0, 1).otherwise(0),
        "chin": ratio(now - past, F.abs(now) + F.abs(past), mode),
    }
    scored = base.withColumns(variables).withColumn(
        "ohlson_o_score", -_weighted(O_WEIGHTS, O_INTERCEPT))
    rules = [
        quality.gap_rule("quarter_gap_4", 4, "Err: Broken history for O-Score (Gap != 4)"),
        ("log_size IS NULL", "log_size is null (Check Assets/CPI)"),
        *quality.component_null_rules([v for v in variables if v != "log_size"]),
    ]
    return quality.apply_rules(scored, rules).select(
        *QUARTER, *variables, "ohlson_o_score", "status", "unqualified_reason")


def daily_returns(quotes: DataFrame, ctx: RunContext) -> DataFrame:
    """Log returns of every stock and of the index on the same day."""
    clean_rows = clean.qualified_only(quotes)
    ret = positive_ln(ratio("price_close", "price_basic"))
    is_index = F.col("ticker") == ctx.benchmark
    # To their stocks before the index makes them wider; nothing moves if they are there already.
    stocks = clean_rows.where(~is_index).select(
        "ticker", "date", ret.alias("stock_ret")).repartition(*BY_TICKER)
    index = clean_rows.where(is_index).select("date", ret.alias("ret"))
    return combine.with_benchmark(stocks, index)


def beta_vol(quotes: DataFrame, ctx: RunContext, rows: int = YEAR_ROWS,
             min_rows: int = MIN_VOL_ROWS) -> DataFrame:
    """One-year volatility of stock and index."""
    vol = rolling_stddev(
        daily_returns(quotes, ctx), BY_TICKER, "date",
        {"vol_stock_1y": "stock_ret", "vol_mkt_1y": "mkt_ret"}, rows,
        counts={"count_trading_days": "vol_stock_1y"},
    )
    rules = [
        ("stock_ret IS NULL", "stock_ret (log return) is null"),
        ("mkt_ret IS NULL", "mkt_ret (market log return) is null"),
        quality.min_history_rule("count_trading_days", min_rows,
                                 f"Err: Not enough trading days (<{min_rows})"),
        *quality.component_null_rules(["vol_stock_1y", "vol_mkt_1y"]),
    ]
    return quality.apply_rules(vol, rules)


def beta_bab(vol: DataFrame, rows: int = CORR_ROWS, min_rows: int = MIN_CORR_ROWS) -> DataFrame:
    """Shrunk beta at each quarter end and its negative as the betting-against-beta score."""
    daily = clean.qualified_only(vol).select(
        "ticker", "date", "stock_ret", "mkt_ret", "vol_stock_1y", "vol_mkt_1y")
    daily = rolling_sum(daily, BY_TICKER, "date",
                        {"stock_ret_3d": "stock_ret", "mkt_ret_3d": "mkt_ret"}, 3)
    daily = rolling_corr(daily, BY_TICKER, "date", "stock_ret_3d", "mkt_ret_3d", rows,
                         "rho_4y", "count_corr_days")
    year, quarter = F.year("date").cast("bigint"), F.quarter("date").cast("bigint")
    beta = F.col("rho_4y") * ratio("vol_stock_1y", "vol_mkt_1y")
    final = BETA_WEIGHT * F.col("beta_ts") + BETA_PRIOR
    daily = daily.withColumns({"year": year, "quarter": quarter, "beta_ts": beta})
    daily = daily.withColumns({
        "absolute_quarter": F.col("year") * 4 + F.col("quarter"),
        "beta_final": final,
        "bab_score": -final,
    })
    ends = last_in_period(daily, BY_TICKER, [INDEX])
    rules = [
        quality.min_history_rule("count_corr_days", min_rows,
                                 f"Err: Not enough data for correlation (<{min_rows} days)"),
        ("beta_ts IS NULL", "beta_ts is null (check vol_mkt_1y)"),
    ]
    return quality.apply_rules(ends, rules).select(
        *QUARTER, "vol_stock_1y", "vol_mkt_1y", "stock_ret_3d", "mkt_ret_3d", "rho_4y",
        "count_corr_days", "beta_ts", "beta_final", "bab_score", "status", "unqualified_reason")


def safety(ttm: DataFrame, bab: DataFrame, z: DataFrame, o: DataFrame) -> DataFrame:
    """Beta, leverage, default risk, solvency and earnings stability side by side.

    Rows known to only one input take part in the 16-row earnings window, as the full outer
    join leaves them there.
    """
    balance = valid_ttm(ttm).select(
        *QUARTER, "total_assets", "net_income_parent_ttm", book_equity().alias("book_equity"),
        "short_term_debt", "long_term_debt", "minority_interest", "preferred_stock")
    scores = [
        clean.qualified_only(df).select(*QUARTER, name)
        for df, name in ((bab, "bab_score"), (z, "altman_z_score"), (o, "ohlson_o_score"))
    ]
    keyed = [df.withColumns({c: F.col(c).cast("bigint") for c in QUARTER[1:]})
             for df in (balance, *scores)]
    joined = combine.full_outer_chain(keyed, QUARTER)
    claims = sum((F.col(c) for c in ("long_term_debt", "minority_interest", "preferred_stock")),
                 F.col("short_term_debt"))
    joined = joined.withColumns({
        "lev_score": -ratio(claims, "total_assets"),
        "roe": ratio("net_income_parent_ttm", "book_equity"),
    })
    rolled = rolling_stddev(joined, BY_TICKER, INDEX, {"evol_raw": "roe"}, EVOL_QUARTERS,
                            counts={"count_roe_quarters": "evol_raw"})
    rolled = rolled.withColumn("evol_score", -F.col("evol_raw"))
    rules = [
        quality.min_history_rule(
            "count_roe_quarters", MIN_EVOL_QUARTERS,
            f"Err: Not enough ROE history for EVOL (<{MIN_EVOL_QUARTERS} quarters)"),
        *quality.component_null_rules(
            ["bab_score", "altman_z_score", "ohlson_o_score", "lev_score"], "missing_{}"),
        ("evol_raw IS NULL", "missing_evol"),
    ]
    return quality.apply_rules(rolled, rules).select(
        *QUARTER, "bab_score", "lev_score", "ohlson_o_score", "altman_z_score", "evol_score",
        "status", "unqualified_reason")


def value_hist(ttm: DataFrame, ctx: RunContext) -> DataFrame:
    """Book equity of two quarters ago over the current market value."""
    rows = gap_lag(valid_ttm(ttm), BY_TICKER, INDEX, {"book_equity_6m_lag": book_equity()}, 2,
                   "gap_6m")
    rows = rows.withColumn(
        "value_raw_score", ratio("book_equity_6m_lag", "market_cap", ctx.ratio_mode))
    rules = [
        quality.gap_rule("gap_6m", 2, "Err: Missing 6-month lag for Book Equity (Gap != 2)"),
        ("book_equity_6m_lag IS NULL", "Err: Lagged Book Equity is null"),
        ("value_raw_score IS NULL", "Err: Value Score is null"),
    ]
    return quality.apply_rules(rows, rules).select(
        *QUARTER, "gap_6m", "market_cap", "book_equity_6m_lag", "value_raw_score", "status",
        "unqualified_reason")


def value_recent(ttm: DataFrame, dim_company: DataFrame, ctx: RunContext) -> DataFrame:
    """Newest book equity over today's market value, gated by the age of both."""
    today = F.lit(ctx.today)
    market = dim_company.where(F.col("ticker") != ctx.benchmark).select(
        "ticker", "market_cap", F.col("gold_updated_at").alias("last_market_cap_update"))
    books = valid_ttm(ttm).select(
        "ticker", F.col("year").alias("report_year"), F.col("quarter").alias("report_quarter"),
        F.col(INDEX).alias("latest_absolute_quarter"), book_equity().alias("latest_book_equity"))
    latest = latest_per_key(books, BY_TICKER, "latest_absolute_quarter")
    this_quarter = F.lit(ctx.absolute_quarter).cast("bigint")
    rows = market.join(latest, "ticker").withColumns({
        "days_since_update": F.datediff(today, F.to_date("last_market_cap_update")),
        "current_absolute_quarter": this_quarter,
        "quarters_delayed": this_quarter - F.col("latest_absolute_quarter"),
        "value_recent_score": ratio("latest_book_equity", "market_cap"),
    })
    rules = [
        quality.staleness_rule("days_since_update", MAX_AGE_DAYS,
                               "Err: Stale Data in gold_dim_company (> 10 days)"),
        quality.staleness_rule("quarters_delayed", MAX_DELAY_QUARTERS,
                               "Err: Stale Fundamental Data (Delayed > 2 Quarters)"),
        ("value_recent_score IS NULL", "Err: Invalid Value Recent Score"),
    ]
    return quality.apply_rules(rows, rules)


def momentum_hist(quotes: DataFrame, ctx: RunContext, price: str = "price_basic",
                  check_short_gap: bool = False) -> DataFrame:
    """Price one month ago over price twelve months ago at the last month of each quarter."""
    stocks = clean.qualified_only(quotes).where(F.col("ticker") != ctx.benchmark)
    daily = stocks.select("ticker", "date", "year", "quarter", "month", "absolute_month", INDEX,
                          F.col(price).alias("_price"))
    months = last_in_period(daily, BY_TICKER, ["absolute_month"])
    months = multi_lag(months, BY_TICKER, "absolute_month",
                       {"price_t_1": ("_price", 1), "price_t_12": ("_price", 12)})
    months = months.withColumns({
        "gap_12m": gap("absolute_month", BY_TICKER, 12),
        "_gap_1m": gap("absolute_month", BY_TICKER, 1),
        "momentum_raw_score": ratio("price_t_1", "price_t_12", ctx.ratio_mode) - 1,
    })
    ends = last_in_period(months, BY_TICKER, ["year", "quarter"], "month")
    rules = [
        quality.gap_rule("gap_12m", 12, "Err: Missing 12-month lag for Price (Gap != 12)"),
        ("price_t_1 IS NULL", "Err: Lagged Price 1m is null"),
        quality.null_or_zero_rule("price_t_12", "Err: Lagged Price 12m is null or zero"),
    ]
    if check_short_gap:
        rules.insert(1, quality.gap_rule(
            "_gap_1m", 1, "Err: Missing 1-month lag for Price (Gap != 1)"))
    return quality.apply_rules(ends, rules).select(
        *QUARTER, F.col("month").alias("end_of_quarter_month"), "absolute_month", "gap_12m",
        "price_t_1", "price_t_12", "momentum_raw_score", "status", "unqualified_reason")


def momentum_recent(quotes: DataFrame, ctx: RunContext, price: str = "price_basic") -> DataFrame:
    """Price 21 rows ago over price 252 rows ago at the newest trade of each stock."""
    stocks = clean.qualified_only(quotes).where(F.col("ticker") != ctx.benchmark)
    daily = stocks.select("ticker", "date", F.col(price).alias("_price"))
    lags = {}
    for n in (MONTH_ROWS, YEAR_ROWS):
        lags |= {f"price_t_{n}": ("_price", n), f"date_t_{n}": ("date", n)}
    latest = latest_per_key(multi_lag(daily, BY_TICKER, "date", lags), BY_TICKER, "date")
    rows = latest.withColumns({
        "days_since_last_trade": F.datediff(F.lit(ctx.today), F.col("date")),
        "momentum_recent": ratio(f"price_t_{MONTH_ROWS}", f"price_t_{YEAR_ROWS}",
                                 ctx.ratio_mode) - 1,
    })
    rules = [
        quality.staleness_rule("days_since_last_trade", MAX_AGE_DAYS,
                               "Err: Stale Data (Suspended or no trades > 10 days)"),
        quality.null_or_zero_rule("price_t_21",
                                  "Err: Missing 1-month benchmark (price_t_21 is null or 0)"),
        quality.null_or_zero_rule(
            "price_t_252", "Err: Insufficient 1-year history (price_t_252 is null or 0)"),
        ("momentum_recent IS NULL",
         "Err: Momentum calculation failed (momentum_recent is null)"),
    ]
    return quality.apply_rules(rows, rules).select(
        "ticker", F.col("date").alias("last_trade_date"), "days_since_last_trade", "date_t_21",
        "price_t_21", "date_t_252", "price_t_252", "momentum_recent", "status",
        "unqualified_reason")
