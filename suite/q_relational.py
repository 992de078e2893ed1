"""Cleaning, deduplication, joins, aggregates, windows, ranking, sets and scalar functions."""

from __future__ import annotations


from pyspark.sql import functions as F

from factorloom.catalogue import Indicator, TableSpec
from factorloom.functions import exprs, periods
from factorloom.operators import (
    aggregates,
    clean,
    combine,
    dedup,
    observe,
    ranking,
    topk,
    windows,
)
from factorloom.plans import cleaned, factors, serving
from factorloom.session import scratch_path
from factorloom.sources.store import Warehouse
from suite import inputs
from suite.inputs import CTX, table
from suite.models import models
from suite.registry import cte, query, r, rounded, rs



def row_count():
    return F.count(F.lit(1)).alias("n_rows")


# Projections, filters, casts ---------------------------------------------------------------

def event_docs(spark, sf_dir):
    """Event properties, with an uncastable value for errors and broken text for views."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE event_type WHEN 'error' THEN '{\"k\": \"bad\"}'"
                    " WHEN 'view' THEN 'not json' ELSE props END AS doc")


K_SQL = """CASE WHEN event_type IN ('error', 'view') THEN NULL
    ELSE CAST(json_extract_string(props, '$.k') AS INT) END"""


@query("json_extract_fields", f"""SELECT event_id, {K_SQL} AS k, CAST(NULL AS DOUBLE) AS absent
    FROM events""")
def json_extract_fields(spark, sf_dir):
    fields = (Indicator("k", "k", "int"), Indicator("missing", "absent", "double"))
    return clean.extract_fields(event_docs(spark, sf_dir), "doc", fields, ["event_id"])


@query("try_cast_cols", """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INT)
    AS level, TRY_CAST(substr(o_orderpriority, 3) AS DOUBLE) AS name FROM orders""")
def try_cast_cols(spark, sf_dir):
    parts = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "substr(o_orderpriority, 1, 1) AS level",
        "substr(o_orderpriority, 3) AS name")
    return clean.try_cast_cols(parts, {"level": "int", "name": "double"})


@query("normalize_key", "SELECT c_custkey, upper(c_name) AS ticker FROM customer")
def normalize_key(spark, sf_dir):
    padded = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "'  ' || lower(c_name) || ' ' AS ticker")
    return clean.normalize_key(padded)


@query("regex_filter", """SELECT ticker, company_name FROM x_company_list
    WHERE regexp_matches(ticker, '^[A-Z0-9]{6}$') AND company_name IS NOT NULL""")
def regex_filter(spark, sf_dir):
    rows = clean.regex_filter(inputs.company_list(spark, sf_dir), "ticker", inputs.KEY_PATTERN,
                              not_null=["company_name"])
    return rows.select("ticker", "company_name")


@query("coalesce_default", """SELECT ticker, coalesce(company_name, 'Unknown Company')
    AS company_name FROM x_company_list""")
def coalesce_default(spark, sf_dir):
    rows = clean.fill_defaults(inputs.company_list(spark, sf_dir), cleaned.COMPANY_DEFAULTS)
    return rows.select("ticker", "company_name")


@query("recent_slice", """SELECT event_id FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 2 DAY""")
def recent_slice(spark, sf_dir):
    return clean.recent_slice(table(spark, sf_dir, "events"), "ts", 2).select("event_id")


@query("incremental_slice", """SELECT o_orderkey FROM orders
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F'
                         AND o_orderdate < TIMESTAMP '2000-01-01')""")
def incremental_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    held = orders.where("o_orderstatus = 'F' AND o_orderdate < '2000-01-01'")
    return clean.incremental_slice(orders, held, "o_orderdate").select("o_orderkey")


@query("audit_columns", """SELECT 'suite' AS gold_invocation_id,
    '2001-11-09 06:00:00' AS gold_updated_at, count(*) AS n_rows FROM orders""")
def audit_columns(spark, sf_dir):
    rows = clean.with_audit(table(spark, sf_dir, "orders"), "gold", CTX)
    return rows.groupBy("gold_invocation_id", F.col("gold_updated_at").cast("string")
                        .alias("gold_updated_at")).agg(row_count())


@query("exclude_columns", "SELECT * EXCLUDE (c_name, c_mktsegment) FROM customer")
def exclude_columns(spark, sf_dir):
    return clean.exclude_columns(table(spark, sf_dir, "customer"), "c_name", "c_mktsegment")


@query("presence_flag", """SELECT has_order, count(*) AS n_rows FROM customer LEFT JOIN
    (SELECT DISTINCT o_custkey, 1 AS has_order FROM orders WHERE o_totalprice > 300000)
    ON c_custkey = o_custkey GROUP BY has_order""")
def presence_flag(spark, sf_dir):
    buyers = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(
        F.col("o_custkey").alias("c_custkey")).distinct()
    joined = table(spark, sf_dir, "customer").join(
        clean.with_presence_flag(buyers, "has_order"), "c_custkey", "left")
    return joined.groupBy("has_order").agg(row_count())


@query("qualified_only", "SELECT ticker, year FROM x_div_judged WHERE status = 'qualified'")
def qualified_only(spark, sf_dir):
    staged = cleaned.stage_dividends(inputs.dividends_landing(spark, sf_dir), CTX)
    return clean.qualified_only(cleaned.dividends(staged)).select("ticker", "year")


@query("date_parts_index", """SELECT o_orderkey, year(o_orderdate) AS year,
    month(o_orderdate) AS month, quarter(o_orderdate) AS quarter,
    year(o_orderdate) * 12 + month(o_orderdate) AS absolute_month,
    year(o_orderdate) * 4 + quarter(o_orderdate) AS absolute_quarter FROM orders""")
def date_parts_index(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"))
    return clean.with_period_index(days).drop("date")


@query("case_flag", """SELECT ttm_status, CASE WHEN total_liabilities > total_assets THEN 1
    ELSE 0 END AS oeneg, count(*) AS n_rows FROM x_ttm GROUP BY ALL""")
def case_flag(spark, sf_dir):
    over = F.col("total_liabilities") > F.col("total_assets")
    return models(spark, sf_dir).ttm().groupBy(
        "ttm_status", F.when(over, 1).otherwise(0).alias("oeneg")).agg(row_count())


@query("round_outputs", """SELECT p_partkey, round(p_retailprice / 7, 3) AS unit FROM part""")
def round_outputs(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_retailprice") / 7).alias("raw"))
    return clean.round_outputs(rows, {"unit": "raw"}).drop("raw")


# Deduplication -----------------------------------------------------------------------------

@query("dedup_latest", """SELECT ticker, year, quarter, indicator_id, value FROM x_latest
    WHERE data_type = 'income_statement_quarter'""")
def dedup_latest(spark, sf_dir):
    rows = cleaned.latest_cells(inputs.reports(spark, sf_dir), "income_statement", CTX)
    return rows.drop(cleaned.INGESTED)


@query("dedup_first_by_name", "SELECT * FROM x_companies")
def dedup_first_by_name(spark, sf_dir):
    return cleaned.companies(inputs.company_list(spark, sf_dir), inputs.KEY_PATTERN)


@query("last_in_period", """SELECT o_custkey, absolute_month, o_orderdate AS date, o_orderkey
    FROM (SELECT *, year(o_orderdate) * 12 + month(o_orderdate) AS absolute_month FROM orders)
    QUALIFY row_number() OVER (PARTITION BY o_custkey, absolute_month
                               ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def last_in_period(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").alias("date"), "o_orderkey",
        exprs.absolute_month(F.year("o_orderdate"), F.month("o_orderdate"))
        .alias("absolute_month"))
    return dedup.last_in_period(rows, ["o_custkey"], ["absolute_month"])


@query("latest_per_key", """SELECT user_id, event_id, ts, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return dedup.latest_per_key(rows, ["user_id"], "ts")


def runs(spark, sf_dir):
    """Events as model runs: the type is the model, the user the invocation."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("model_execution_id"), F.col("event_type").alias("unique_id"),
        F.col("user_id").alias("invocation_id"), F.col("ts").alias("generated_at"))


@query("reverse_run_index", """SELECT event_id AS model_execution_id, row_number() OVER (
    PARTITION BY event_type ORDER BY ts DESC, event_id) AS model_invocation_reverse_index
    FROM events""")
def reverse_run_index(spark, sf_dir):
    rows = observe.with_reverse_index(runs(spark, sf_dir))
    return rows.select("model_execution_id", "model_invocation_reverse_index")


# Joins -------------------------------------------------------------------------------------

@query("join_left_dim", """SELECT c_custkey, n_name, r_name FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey""")
def join_left_dim(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf_dir, "region").where("r_name <> 'ASIA'").withColumnRenamed(
        "r_regionkey", "n_regionkey")
    with_nation = combine.left_dims(table(spark, sf_dir, "customer"), [nation], ["c_nationkey"])
    return combine.left_dims(with_nation, [region], ["n_regionkey"]).select(
        "c_custkey", "n_name", "r_name")


@query("join_full_outer_chain", """SELECT nationkey, n_customers, n_suppliers, n_rich FROM
    (SELECT c_nationkey AS nationkey, count(*) AS n_customers FROM customer GROUP BY 1)
    FULL JOIN (SELECT s_nationkey AS nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1)
    USING (nationkey) FULL JOIN (SELECT c_nationkey AS nationkey, count(*) AS n_rich
    FROM customer WHERE c_acctbal > 9000 GROUP BY 1) USING (nationkey)""")
def join_full_outer_chain(spark, sf_dir):
    def per_nation(df, key: str, out: str):
        return df.groupBy(F.col(key).alias("nationkey")).agg(F.count(F.lit(1)).alias(out))

    customers = table(spark, sf_dir, "customer")
    return combine.full_outer_chain([
        per_nation(customers, "c_nationkey", "n_customers"),
        per_nation(table(spark, sf_dir, "supplier"), "s_nationkey", "n_suppliers"),
        per_nation(customers.where("c_acctbal > 9000"), "c_nationkey", "n_rich"),
    ], ["nationkey"])


@query("join_inner_restrict", """SELECT o_orderkey FROM orders WHERE o_custkey IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def join_inner_restrict(spark, sf_dir):
    allowed = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"))
    return combine.restrict_to(table(spark, sf_dir, "orders"), allowed,
                               ["o_custkey"]).select("o_orderkey")


@query("join_date_equi", """SELECT ticker, count(*) AS n_days, min(date) AS first_day,
    max(date) AS last_day, count(mkt_ret) AS n_market,
    round(CAST(sum(CAST(round(stock_ret, 6) AS DECIMAL(18, 6))) AS DOUBLE), 6) + 0.0 AS stock_sum,
    round(CAST(sum(CAST(round(mkt_ret, 6) AS DECIMAL(18, 6))) AS DOUBLE), 6) + 0.0 AS market_sum
    FROM x_daily GROUP BY ticker""")
def join_date_equi(spark, sf_dir):
    """Each day's return beside the market's, summed up per company."""
    rows = factors.daily_returns(models(spark, sf_dir).quotes(), CTX)

    def total(column: str):
        return F.sum(F.round(column, 6).cast("decimal(18,6)")).cast("double")

    sums = rows.groupBy("ticker").agg(
        row_count().alias("n_days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.count("mkt_ret").alias("n_market"), total("stock_ret").alias("stock_sum"),
        total("mkt_ret").alias("market_sum"))
    return rounded(sums, "stock_sum", "market_sum")


@query("join_lookup_left", """SELECT o_orderkey, risk_free_rate FROM (SELECT o_orderkey,
    year(o_orderdate) * 4 + quarter(o_orderdate) AS aq FROM orders)
    LEFT JOIN x_macro ON aq = absolute_quarter""")
def join_lookup_left(spark, sf_dir):
    index = exprs.absolute_quarter(F.year("o_orderdate"), F.quarter("o_orderdate"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", index.alias("absolute_quarter"))
    macro = inputs.macro(spark, sf_dir).select("absolute_quarter", "risk_free_rate")
    return combine.lookup_left(rows, macro, "absolute_quarter").drop("absolute_quarter")


@query("join_with_condition", """SELECT c_custkey, o_orderkey FROM customer
    JOIN orders ON c_custkey = o_custkey AND o_totalprice > 200000""")
def join_with_condition(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return combine.join_where(
        table(spark, sf_dir, "customer"), orders, ["c_custkey"], F.col("o_totalprice") > 200000
    ).select("c_custkey", "o_orderkey")


@query("anti_missing_keys", """SELECT c_custkey FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')""")
def anti_missing_keys(spark, sf_dir):
    state = table(spark, sf_dir, "orders").where("o_orderdate >= '2000-01-01'").select(
        F.col("o_custkey").alias("c_custkey"))
    return combine.missing_keys(table(spark, sf_dir, "customer"), state, "c_custkey")


@query("anti_orphans", """SELECT l_partkey, count(*) AS n_rows FROM lineitem
    WHERE l_quantity > 10 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)
    GROUP BY l_partkey""")
def anti_orphans(spark, sf_dir):
    rows = combine.orphans(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").where("p_size < 40"),
        "l_partkey", "p_partkey", F.col("l_quantity") > 10)
    return rows.groupBy("l_partkey").agg(row_count())


@query("scalar_subquery_filter", """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders)""")
def scalar_subquery_filter(spark, sf_dir):
    mark = clean.high_watermark(table(spark, sf_dir, "orders"), "o_orderdate")
    return table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") > mark).select(
        "l_orderkey", "l_linenumber")


# Aggregates --------------------------------------------------------------------------------

_WIDE = ("net_revenue", "cogs", "gross_profit", "net_income")


@query("pivot_eav", f"SELECT ticker, year, quarter, {rs(*_WIDE, digits=4)} FROM x_is_wide")
def pivot_eav(spark, sf_dir):
    wide = cleaned.statement_wide(inputs.reports(spark, sf_dir), "income_statement", CTX)
    return rounded(wide.select("ticker", "year", "quarter", *_WIDE), *_WIDE, digits=4)


@query("agg_max_by_key", """SELECT user_id, max(ts) AS last_seen FROM events
    WHERE event_type = 'purchase' GROUP BY user_id""")
def agg_max_by_key(spark, sf_dir):
    return aggregates.max_by_key(table(spark, sf_dir, "events"), ["user_id"], "ts", "last_seen",
                                 F.col("event_type") == "purchase")


@query("agg_min_max_group", """SELECT event_type, min(ts) AS first_seen, max(ts) AS last_seen
    FROM events GROUP BY event_type""")
def agg_min_max_group(spark, sf_dir):
    return aggregates.min_max_group(table(spark, sf_dir, "events"), ["event_type"], "ts",
                                    "first_seen", "last_seen")


@query("count_distinct_test", "SELECT count(DISTINCT l_suppkey) AS n_distinct FROM lineitem")
def count_distinct_test(spark, sf_dir):
    return aggregates.distinct_count(table(spark, sf_dir, "lineitem"), "l_suppkey")


@query("count_conditional", """SELECT CAST(count(CASE WHEN l_returnflag = 'R' THEN 1 END) * 10000
    // count(*) AS INT) AS failure_bps FROM lineitem""")
def count_conditional(spark, sf_dir):
    return aggregates.rate_bps(table(spark, sf_dir, "lineitem"), F.col("l_returnflag") == "R")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, sf_dir):
    return aggregates.distinct_rows(table(spark, sf_dir, "lineitem"),
                                    ["l_suppkey", "l_returnflag"])


@query("having_duplicates", """SELECT l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""")
def having_duplicates(spark, sf_dir):
    return aggregates.duplicates(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("agg_global_extrema", """SELECT max(o_orderkey) AS top_key, max(o_orderdate) AS newest
    FROM orders""")
def agg_global_extrema(spark, sf_dir):
    return aggregates.global_extrema(table(spark, sf_dir, "orders"), top_key="o_orderkey",
                                     newest="o_orderdate")


# Time-series windows -----------------------------------------------------------------------

cte("x_cell_series", """SELECT ticker, year * 4 + quarter AS absolute_quarter,
    CAST(rev AS DOUBLE) AS rev, CAST(costs AS DOUBLE) AS costs FROM x_cells""")
SERIES = "PARTITION BY ticker ORDER BY absolute_quarter"


def cell_series(spark, sf_dir):
    return inputs.cells(spark, sf_dir).select(
        "ticker", exprs.absolute_quarter("year", "quarter").alias("absolute_quarter"),
        F.col("rev").cast("double").alias("rev"), F.col("costs").cast("double").alias("costs"))


KEY = ["ticker"]
AQ = "CAST(absolute_quarter AS BIGINT) AS absolute_quarter"


@query("rolling_sum_ttm", f"""SELECT ticker, {AQ}, {rs('rev_ttm', 'costs_ttm', digits=2)} FROM (
    SELECT *, sum(rev) OVER w AS rev_ttm, sum(costs) OVER w AS costs_ttm FROM x_cell_series
    WINDOW w AS ({SERIES} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))""")
def rolling_sum_ttm(spark, sf_dir):
    rows = windows.ttm(cell_series(spark, sf_dir), KEY, "absolute_quarter", ["rev", "costs"])
    return rounded(rows.drop("rev", "costs"), "rev_ttm", "costs_ttm", digits=2)


@query("gap_lag", f"""SELECT ticker, {AQ}, lag(rev, 4) OVER w AS rev_past,
    CAST(absolute_quarter - lag(absolute_quarter, 4) OVER w AS BIGINT) AS gap
    FROM x_cell_series WINDOW w AS ({SERIES})""")
def gap_lag(spark, sf_dir):
    rows = windows.gap_lag(cell_series(spark, sf_dir), KEY, "absolute_quarter",
                           {"rev_past": "rev"}, 4)
    return rows.drop("rev", "costs")


@query("multi_lag", f"""SELECT ticker, {AQ}, lag(rev, 4) OVER w AS rev_1y,
    lag(rev, 12) OVER w AS rev_3y, lag(costs, 16) OVER w AS costs_4y
    FROM x_cell_series WINDOW w AS ({SERIES})""")
def multi_lag(spark, sf_dir):
    rows = windows.multi_lag(cell_series(spark, sf_dir), KEY, "absolute_quarter", {
        "rev_1y": ("rev", 4), "rev_3y": ("rev", 12), "costs_4y": ("costs", 16)})
    return rows.drop("rev", "costs")


@query("lag_rows_with_date", """SELECT ticker, date, CAST(lag(price_close, 21) OVER w AS DOUBLE)
    AS price_t_21, lag(date, 21) OVER w AS date_t_21,
    CAST(lag(price_close, 252) OVER w AS DOUBLE) AS price_t_252,
    lag(date, 252) OVER w AS date_t_252
    FROM x_prices WINDOW w AS (PARTITION BY ticker ORDER BY date)""")
def lag_rows_with_date(spark, sf_dir):
    prices = inputs.price_days(spark, sf_dir).select(
        "ticker", "date", F.col("price_close").cast("double").alias("price"))
    lags = {}
    for n in (21, 252):
        lags |= {f"price_t_{n}": ("price", n), f"date_t_{n}": ("date", n)}
    return windows.multi_lag(prices, KEY, "date", lags).drop("price")


cte("x_ret_series", """SELECT ticker, date, CASE WHEN price_basic > 0 AND price_close > 0 THEN
    ln(CAST(price_close AS DOUBLE) / CAST(price_basic AS DOUBLE)) END AS ret,
    total_volume FROM x_prices""")
DAYS = "PARTITION BY ticker ORDER BY date ROWS BETWEEN {} PRECEDING AND CURRENT ROW"


def return_series(spark, sf_dir):
    ret = exprs.positive_ln(exprs.ratio("price_close", "price_basic"))
    return inputs.price_days(spark, sf_dir).select("ticker", "date", ret.alias("ret"),
                                                   "total_volume")


@query("rolling_stddev", f"""SELECT ticker, date, {rs('vol')}, n_days FROM (
    SELECT *, stddev_samp(ret) OVER w AS vol, count(ret) OVER w AS n_days FROM x_ret_series
    WINDOW w AS ({DAYS.format(251)}))""")
def rolling_stddev(spark, sf_dir):
    rows = windows.rolling_stddev(return_series(spark, sf_dir), KEY, "date", {"vol": "ret"}, 252,
                                  counts={"n_days": "vol"})
    return rounded(rows.drop("ret", "total_volume"), "vol")


@query("rolling_sum_3d", f"""SELECT ticker, date, {rs('ret_3d')} FROM (
    SELECT *, sum(ret) OVER w AS ret_3d FROM x_ret_series WINDOW w AS ({DAYS.format(2)}))""")
def rolling_sum_3d(spark, sf_dir):
    rows = windows.rolling_sum(return_series(spark, sf_dir), KEY, "date", {"ret_3d": "ret"}, 3)
    return rounded(rows.drop("ret", "total_volume"), "ret_3d")


@query("rolling_corr", f"""SELECT ticker, date, {rs('rho')}, n_days FROM (
    SELECT ticker, date, CASE WHEN isnan(rho) THEN NULL ELSE rho END AS rho, n_days FROM (
    SELECT *, corr(ret, total_volume) OVER w AS rho, count(ret) OVER w AS n_days
    FROM x_ret_series WINDOW w AS ({DAYS.format(1007)})))""")
def rolling_corr(spark, sf_dir):
    rows = windows.rolling_corr(return_series(spark, sf_dir), KEY, "date", "ret", "total_volume",
                                1008, "rho", "n_days")
    return rounded(rows.drop("ret", "total_volume"), "rho")


# Ranks and scores --------------------------------------------------------------------------

LINE = ["l_orderkey", "l_linenumber"]


def lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *LINE, "l_returnflag", "l_extendedprice", "l_quantity")


@query("rank_cross_section", """SELECT l_orderkey, l_linenumber, l_extendedprice,
    rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS price_rank,
    rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS quantity_rank
    FROM lineitem""")
def rank_cross_section(spark, sf_dir):
    """Three groups hold all rows."""
    rows = ranking.xs_rank(
        lines(spark, sf_dir), ["l_returnflag"],
        {"price_rank": "l_extendedprice", "quantity_rank": "l_quantity"})
    return rows.drop("l_returnflag", "l_quantity")


@query("rank_nullable", """SELECT c_custkey, CASE WHEN bal IS NOT NULL THEN rank() OVER (
    PARTITION BY c_mktsegment ORDER BY bal NULLS LAST) END AS bal_rank
    FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer)""")
def rank_nullable(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_mktsegment", "CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal")
    ranked = ranking.xs_rank(rows, ["c_mktsegment"], {"bal_rank": "bal"})
    return ranked.drop("c_mktsegment", "bal")


@query("rank_desc", """SELECT ticker, CAST(absolute_quarter AS BIGINT) AS absolute_quarter,
    rank() OVER (PARTITION BY absolute_quarter ORDER BY rev DESC) AS rev_rank
    FROM x_cell_series""")
def rank_desc(spark, sf_dir):
    ranked = ranking.xs_rank(cell_series(spark, sf_dir), ["absolute_quarter"],
                             {"rev_rank": "rev"}, descending=True, nullable=False)
    return ranked.drop("rev", "costs")


@query("zscore_partition", """SELECT l_orderkey, l_linenumber, l_extendedprice, round(
    (l_extendedprice - avg(l_extendedprice) OVER w) / nullif(stddev_samp(l_extendedprice) OVER w,
    0), 6) + 0.0 AS z FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)""")
def zscore_partition(spark, sf_dir):
    rows = ranking.zscore(lines(spark, sf_dir), ["l_returnflag"], {"z": "l_extendedprice"})
    return rounded(rows.drop("l_returnflag", "l_quantity"), "z")


@query("zscore_global", """SELECT l_orderkey, l_linenumber, l_extendedprice, round(
    (l_extendedprice - avg(l_extendedprice) OVER ()) / nullif(stddev_samp(l_extendedprice)
    OVER (), 0), 6) + 0.0 AS z FROM lineitem""")
def zscore_global(spark, sf_dir):
    rows = ranking.zscore(lines(spark, sf_dir), [], {"z": "l_extendedprice"})
    return rounded(rows.drop("l_returnflag", "l_quantity"), "z")


cte("x_metrics", """SELECT event_type AS metric_name, 'events' AS full_table_name,
    'value' AS column_name, date_trunc('day', ts) AS bucket_start,
    date_trunc('day', ts) + INTERVAL 1 DAY AS bucket_end,
    CAST(count(*) AS DOUBLE) AS metric_value FROM events GROUP BY ALL""")
cte("x_running", """SELECT *, avg(metric_value) OVER w AS training_avg,
    stddev_samp(metric_value) OVER w AS training_stddev, count(metric_value) OVER w
    AS training_set_size, last_value(bucket_end) OVER w AS training_end,
    first_value(bucket_end) OVER w AS training_start FROM x_metrics
    WINDOW w AS (PARTITION BY metric_name, full_table_name, column_name ORDER BY bucket_start
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")


def metrics(spark, sf_dir):
    """Events per type and day as monitored metrics."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    counted = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("metric_name"), day.alias("bucket_start")
    ).agg(F.count(F.lit(1)).cast("double").alias("metric_value"))
    return counted.withColumns({
        "full_table_name": F.lit("events"), "column_name": F.lit("value"),
        "bucket_end": F.col("bucket_start") + F.expr("INTERVAL 1 DAY"),
    })


@query("running_stats", f"""SELECT metric_name, bucket_start, metric_value,
    {rs('training_avg', 'training_stddev')}, training_set_size, training_end, training_start
    FROM x_running""")
def running_stats(spark, sf_dir):
    rows = windows.running_stats(metrics(spark, sf_dir), list(observe.METRIC_KEY),
                                 "bucket_start", "metric_value", "bucket_end")
    rows = rows.drop("full_table_name", "column_name", "bucket_end")
    return rounded(rows, "training_avg", "training_stddev")


@query("first_last_of_day", """SELECT event_id AS model_execution_id,
    first_value(user_id) OVER w = user_id AS is_the_first_invocation_of_the_day,
    last_value(user_id) OVER w = user_id AS is_the_last_invocation_of_the_day
    FROM events WINDOW w AS (PARTITION BY CAST(ts AS DATE) ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def first_last_of_day(spark, sf_dir):
    return observe.with_day_ends(runs(spark, sf_dir)).select(
        "model_execution_id", "is_the_first_invocation_of_the_day",
        "is_the_last_invocation_of_the_day")


# Order and limit ---------------------------------------------------------------------------

@query("order_multi", """SELECT ticker, CAST(absolute_quarter AS BIGINT) AS absolute_quarter,
    qmj_rank FROM x_obt""")
def order_multi(spark, sf_dir):
    return serving.in_report_order(models(spark, sf_dir).obt()).select(
        "ticker", "absolute_quarter", "qmj_rank")


@query("top_resource_queries", """SELECT CAST(event_id AS VARCHAR) AS query_id,
    value AS cpu_time_s FROM events ORDER BY value DESC, query_id LIMIT 20""")
def top_resource_queries(spark, sf_dir):
    audit = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("query_id"), F.col("value").alias("cpu_time_s"))
    return topk.top_queries(audit, "cpu")


@query("table_sort_order", """SELECT event_type, count(*) AS n_rows, TRUE AS sorted
    FROM events GROUP BY event_type""")
def table_sort_order(spark, sf_dir):
    from pyspark.sql import Window as W

    held = Warehouse(spark, scratch_path(spark, "tables"))
    held.replace(table(spark, sf_dir, "events"),
                 TableSpec("events", "", ("event_type",), ("ts",)))
    stored = held.read("events").select(
        "event_type", "ts", F.input_file_name().alias("file"),
        F.monotonically_increasing_id().alias("pos"))
    before = F.lag("ts").over(W.partitionBy("file").orderBy("pos"))
    in_order = F.coalesce(before >= F.col("ts"), F.lit(True))
    return stored.withColumn("_ok", in_order).groupBy("event_type").agg(
        row_count(), F.bool_and("_ok").alias("sorted"))


# Set operations ----------------------------------------------------------------------------

@query("except_orphans", """SELECT replace(url, 'http://', '') AS location FROM pages
    EXCEPT SELECT replace(url, 'http://', '') FROM pages WHERE html LIKE '%lang="fr"%'""")
def except_orphans(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    inventory = pages.select(F.replace("url", F.lit("http://"), F.lit("")).alias("location"))
    live = pages.where(F.col("html").contains('lang="fr"')).select(F.col("url").alias("location"))
    return combine.orphan_locations(inventory, live, "http://")


@query("union_all_runs", """SELECT event_id, CASE WHEN event_type = 'error' THEN value END
    AS value FROM events WHERE event_type IN ('error', 'view')""")
def union_all_runs(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return combine.union_runs(
        events.where("event_type = 'error'").select("event_id", "value"),
        events.where("event_type = 'view'").select("event_id"))


cte("x_key_state", """SELECT o_custkey AS ticker, CASE WHEN max(o_orderdate)
    < TIMESTAMP '2001-01-01' THEN 'inactive' ELSE 'active' END AS ticker_status
    FROM orders GROUP BY o_custkey""")


def key_state(spark, sf_dir):
    old = F.max("o_orderdate") < F.lit("2001-01-01")
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("ticker")).agg(
        F.when(old, "inactive").otherwise("active").alias("ticker_status"))


@query("set_delta", """SELECT ticker, CASE WHEN s IS NULL THEN 'new' WHEN k IS NULL
    THEN 'disappeared' WHEN s = 'inactive' THEN 'reappeared' ELSE 'unchanged' END AS change FROM
    (SELECT c_custkey AS ticker, 1 AS k FROM customer WHERE c_acctbal > 0)
    FULL JOIN (SELECT ticker, ticker_status AS s FROM x_key_state) USING (ticker)""")
def set_delta(spark, sf_dir):
    reference = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("ticker"))
    return combine.key_delta(reference, key_state(spark, sf_dir))


# Scalar functions --------------------------------------------------------------------------

@query("fn_string", """SELECT c_custkey, upper(trim(' ' || c_name || ' ')) AS up,
    lower(c_mktsegment) AS low, concat_ws('|', c_name, NULL, c_mktsegment) AS joined,
    replace(c_name, '#', '-') AS dashed, nullif(CASE WHEN c_acctbal > 0 THEN '' ELSE 'neg' END,
    '') AS word FROM customer""")
def fn_string(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", exprs.catalogue_text(F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("up"),
        F.lower("c_mktsegment").alias("low"),
        F.concat_ws("|", "c_name", F.lit(None).cast("string"), "c_mktsegment").alias("joined"),
        F.replace("c_name", F.lit("#"), F.lit("-")).alias("dashed"),
        F.nullif(F.when(F.col("c_acctbal") > 0, "").otherwise("neg"), F.lit("")).alias("word"))


@query("fn_regex", r"""SELECT page_id, regexp_matches(url, '^https?://[a-z.]+/') AS ok,
    trim(regexp_replace(regexp_replace('/* ' || url || ' */ ' || html, '/\*[\s\S]*?\*/', '', 'g'),
    '\s+', ' ', 'g')) AS one_line FROM pages""")
def fn_regex(spark, sf_dir):
    commented = F.concat(F.lit("/* "), "url", F.lit(" */ "), "html")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").rlike("^https?://[a-z.]+/").alias("ok"),
        exprs.one_line_query(commented).alias("one_line"))


@query("fn_contains", """SELECT doc_id, contains(upper(text), 'THE') AS found,
    'Q' || source || ' - ' || lang AS label FROM documents""")
def fn_contains(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.upper("text").contains("the".upper().strip()).alias("found"),
        F.concat_ws(" - ", F.concat(F.lit("Q"), "source"), "lang").alias("label"))


@query("fn_math", """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN round(ln(c_acctbal), 6) + 0.0
    END AS ln_bal, abs(c_acctbal) AS abs_bal, -c_acctbal AS minus_bal,
    round(1000 / nullif(c_acctbal, 0), 6) + 0.0 AS inverse,
    CASE WHEN c_custkey > 10 THEN greatest(c_acctbal, 100) END AS top FROM customer""")
def fn_math(spark, sf_dir):
    second = F.when(F.col("c_custkey") > 10, F.lit(100.0))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", r(exprs.positive_ln("c_acctbal")).alias("ln_bal"),
        F.abs("c_acctbal").alias("abs_bal"), (-F.col("c_acctbal")).alias("minus_bal"),
        r(exprs.ratio(F.lit(1000), "c_acctbal")).alias("inverse"),
        exprs.strict_greatest("c_acctbal", second).alias("top"))


@query("fn_date", """SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m,
    quarter(o_orderdate) AS q, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-11-10')
    AS age, CAST(o_orderdate AS DATE) + 30 AS due, CAST(date_trunc('month', o_orderdate) AS DATE)
    AS month_start, o_orderdate - INTERVAL 2 DAY AS earlier FROM orders""")
def fn_date(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(day).cast("bigint").alias("y"), F.month(day).cast("bigint").alias("m"),
        F.quarter(day).cast("bigint").alias("q"),
        F.datediff(F.lit(CTX.today), day).cast("bigint").alias("age"),
        F.date_add(day, 30).alias("due"), F.trunc(day, "month").alias("month_start"),
        (F.col("o_orderdate") - F.expr("INTERVAL 2 DAYS")).alias("earlier"))


@query("fn_tz", """SELECT event_id, ts + INTERVAL 7 HOUR AS local_time FROM events""")
def fn_tz(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.convert_timezone(F.lit("UTC"), F.lit(CTX.display_zone), F.col("ts"))
        .alias("local_time"))


@query("fn_json", """SELECT event_id, json_extract_string(props, '$.k') AS k,
    '{"type":"' || event_type || '"}' AS doc, event_type = 'view' AS broken FROM events""")
def fn_json(spark, sf_dir):
    parsed = F.from_json("doc", "k string, _bad string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = table(spark, sf_dir, "events").join(event_docs(spark, sf_dir), "event_id")
    return rows.select(
        "event_id", F.get_json_object("props", "$.k").alias("k"),
        F.to_json(F.struct(F.col("event_type").alias("type"))).alias("doc"),
        parsed["_bad"].isNotNull().alias("broken"))


@query("fn_conditional", """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN
    o_orderpriority END AS known, coalesce(CASE WHEN o_totalprice > 250000 THEN 'large' END,
    'small') AS size, o_orderstatus NOT IN ('P') AS settled FROM orders""")
def fn_conditional(spark, sf_dir):
    large = F.when(F.col("o_totalprice") > 250000, "large")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus").isin("F", "O"), F.col("o_orderpriority"))
        .alias("known"), F.coalesce(large, F.lit("small")).alias("size"),
        (~F.col("o_orderstatus").isin("P")).alias("settled"))


@query("fn_cast", """SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(20,4)) AS VARCHAR)
    AS price, TRY_CAST(p_name AS DOUBLE) AS number, CAST(p_size > 20 AS INT) AS big,
    TRY_CAST('20' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-01-31' AS DATE) AS day
    FROM part""")
def fn_cast(spark, sf_dir):
    day = F.concat(F.lit("20"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("-01-31"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_retailprice").cast("decimal(20,4)").cast("string").alias("price"),
        F.col("p_name").try_cast("double").alias("number"),
        (F.col("p_size") > 20).cast("int").alias("big"), day.try_cast("date").alias("day"))


@query("fn_array", """SELECT l_orderkey, l_linenumber, u.k AS name, u.v AS amount FROM (
    SELECT *, unnest([{'k': 'tax', 'v': l_tax}, {'k': 'discount', 'v': l_discount}]) AS u
    FROM lineitem)""")
def fn_array(spark, sf_dir):
    packed = table(spark, sf_dir, "lineitem").selectExpr(
        *LINE, "array(struct('tax' AS name, l_tax AS amount),"
               " struct('discount' AS name, l_discount AS amount)) AS data")
    return packed.select(*LINE, F.explode("data").alias("data")).select(*LINE, "data.*")


@query("fn_period", """SELECT o_orderkey,
    CASE WHEN quarter(o_orderdate) = 1 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END
        AS last_year,
    CASE WHEN quarter(o_orderdate) = 1 THEN 4 ELSE quarter(o_orderdate) - 1 END AS last_quarter,
    year(o_orderdate) - 8 AS fallback_year,
    2001 * 4 + 3 - (year(o_orderdate) * 4 + quarter(o_orderdate)) + 2 AS quarters,
    2000 - year(o_orderdate) + 1 AS years,
    CASE WHEN CAST(o_orderdate AS DATE) <= DATE '2001-11-09' THEN CAST(floor(
        date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-11-09')
        * (CAST(250 AS DOUBLE) / 365)) AS BIGINT) + 20 END AS sessions FROM orders""")
def fn_period(spark, sf_dir):
    day, today = F.to_date("o_orderdate"), F.lit(CTX.today)
    year, quarter = periods.previous_quarter(day)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", year.alias("last_year"), quarter.alias("last_quarter"),
        periods.fallback_year(day).alias("fallback_year"),
        periods.quarters_to_fetch(day, today).alias("quarters"),
        periods.years_to_fetch(day, today).alias("years"),
        periods.trading_days_to_fetch(day, today).alias("sessions"))


