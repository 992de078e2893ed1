"""Appends, merges, snapshots and ingestion state."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from factorloom.catalogue import TableSpec
from factorloom.operators import incremental, state
from factorloom.plans import cleaned
from suite import inputs
from suite.inputs import CTX, table
from suite.q_relational import key_state
from suite.q_sources import new_store
from suite.registry import cte, query

T0 = datetime(2001, 11, 1, tzinfo=timezone.utc)
T1 = datetime(2001, 11, 9, tzinfo=timezone.utc)
T0_SQL, T1_SQL = "TIMESTAMP '2001-11-01 00:00:00'", "TIMESTAMP '2001-11-09 00:00:00'"


def naive(df, *columns: str):
    """UTC times without zone, as the SQL side returns them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# Appends and merges ------------------------------------------------------------------------

@query("append_incremental", "SELECT o_orderkey, o_orderdate FROM orders")
def append_incremental(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    held = orders.where("o_orderdate < '2000-01-01'")
    return incremental.append_incremental(orders, held, "o_orderdate")


@query("merge_latest", """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_retailprice * 2
    ELSE p_retailprice END AS p_retailprice, p_brand FROM part
    UNION ALL SELECT p_partkey + 1000000000, p_retailprice, p_brand FROM part WHERE p_size < 5""")
def merge_latest(spark, sf_dir):
    held = new_store(spark)
    spec = TableSpec("parts", "", ("p_brand",), ("p_partkey",))
    keys = ["p_partkey", "p_brand"]
    parts = table(spark, sf_dir, "part")
    fields = ["p_partkey", "p_retailprice", "p_brand"]
    changed = parts.where("p_size > 25").withColumn("p_retailprice", F.col("p_retailprice") * 2)
    added = parts.where("p_size < 5").withColumn("p_partkey", F.col("p_partkey") + 1_000_000_000)
    held.merge(parts.select(*fields), spec, keys)
    held.merge(changed.select(*fields).unionByName(added.select(*fields)), spec, keys)
    return held.read("parts")


@query("sync_schema", """SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_orderpriority,
    o_totalprice FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    WHERE o_orderstatus <> 'F'""")
def sync_schema(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    old = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_custkey")
    new = orders.where("o_orderstatus <> 'F'").select(
        "o_orderkey", "o_orderpriority", "o_totalprice")
    return incremental.sync_all_columns(old, new).unionByName(new)


@query("full_refresh_table", """SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem
    GROUP BY l_suppkey""")
def full_refresh_table(spark, sf_dir):
    held = new_store(spark)
    spec = TableSpec("per_supplier", "", (), ("l_suppkey",))
    lines = table(spark, sf_dir, "lineitem")
    for rows in (lines.where("l_quantity > 10"), lines):
        held.replace(rows.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity")), spec)
    return held.read("per_supplier")


# Snapshots: customers before and after a day ------------------------------------------------

CHECK = ["c_mktsegment"]


def customers_before(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")


def customers_after(spark, sf_dir):
    """Every tenth customer changes segment, the next one leaves, the third brings a new one."""
    rows = customers_before(spark, sf_dir).where("c_custkey % 10 <> 1").withColumn(
        "c_mktsegment", F.expr("CASE WHEN c_custkey % 10 = 0 THEN 'MOVED' ELSE c_mktsegment END"))
    added = customers_before(spark, sf_dir).where("c_custkey % 10 = 2").withColumn(
        "c_custkey", F.col("c_custkey") + 1_000_000_000_000)
    return rows.unionByName(added)


NEVER = "CAST(NULL AS TIMESTAMP)"
cte("x_snap_common", f"""
SELECT c_custkey, c_mktsegment, {T0_SQL} AS valid_from, {NEVER} AS valid_to, FALSE AS is_deleted
FROM customer WHERE c_custkey % 10 NOT IN (0, 1)
UNION ALL SELECT c_custkey, c_mktsegment, {T0_SQL}, {T1_SQL}, FALSE FROM customer
WHERE c_custkey % 10 = 0 AND c_mktsegment <> 'MOVED'
UNION ALL SELECT c_custkey, 'MOVED', {T1_SQL}, {NEVER}, FALSE FROM customer
WHERE c_custkey % 10 = 0
UNION ALL SELECT c_custkey + 1000000000000, c_mktsegment, {T1_SQL}, {NEVER}, FALSE FROM customer
WHERE c_custkey % 10 = 2""")


def snapshot(spark, sf_dir, mode: str):
    first = incremental.scd2(None, customers_before(spark, sf_dir), ["c_custkey"], CHECK, T0)
    after = incremental.scd2(first, customers_after(spark, sf_dir), ["c_custkey"], CHECK, T1, mode)
    return naive(after, "valid_from", "valid_to")


def _gone(end: str) -> str:
    return (f"SELECT c_custkey, c_mktsegment, {T0_SQL}, {end}, FALSE FROM customer"
            " WHERE c_custkey % 10 = 1")


@query("scd2_check", f"SELECT * FROM x_snap_common UNION ALL {_gone(NEVER)}")
def scd2_check(spark, sf_dir):
    return snapshot(spark, sf_dir, "ignore")


@query("scd2_delete_invalidate", f"SELECT * FROM x_snap_common UNION ALL {_gone(T1_SQL)}")
def scd2_delete_invalidate(spark, sf_dir):
    return snapshot(spark, sf_dir, "invalidate")


@query("scd2_delete_new_record", f"""SELECT * FROM x_snap_common UNION ALL {_gone(T1_SQL)}
    UNION ALL SELECT c_custkey, c_mktsegment, {T1_SQL}, {NEVER}, TRUE FROM customer
    WHERE c_custkey % 10 = 1""")
def scd2_delete_new_record(spark, sf_dir):
    return snapshot(spark, sf_dir, "new_record")


@query("changed_keys", """SELECT DISTINCT ticker FROM x_div_judged
    WHERE status = 'qualified' AND cash_dividend > 0 AND year % 2 = 0""")
def changed_keys(spark, sf_dir):
    """Dividends of even years rise between two snapshots."""
    staged = cleaned.stage_dividends(inputs.dividends_landing(spark, sf_dir), CTX)
    rows = cleaned.dividends(staged).where("status = 'qualified'").select(
        "ticker", "year", "cash_dividend", "stock_dividend")
    raised = rows.withColumn("cash_dividend", F.expr(
        "CASE WHEN year % 2 = 0 THEN cash_dividend + 1 ELSE cash_dividend END"))
    check = ["cash_dividend", "stock_dividend"]
    first = incremental.scd2(None, rows, ["ticker", "year"], check, T0)
    history = incremental.scd2(first, raised, ["ticker", "year"], check, T1, "invalidate")
    return incremental.changed_keys(history, T1)


# Ingestion state ---------------------------------------------------------------------------

def order_state(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.lit("b0").alias("batch_id"), F.col("o_orderstatus").alias("data_type"),
        F.col("o_orderkey").cast("string").alias("ticker"),
        F.col("o_orderdate").cast("timestamp").alias("created_time"))


@query("expire_state", """SELECT CAST(o_orderkey AS VARCHAR) AS ticker,
    o_orderstatus AS data_type FROM orders
    WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2000-08-01')""")
def expire_state(spark, sf_dir):
    as_of = datetime(2000, 8, 2, tzinfo=timezone.utc)
    kept = state.expire_state(order_state(spark, sf_dir), "F", as_of)
    return kept.select("ticker", "data_type")


@query("record_state", """SELECT batch_id, data_type, count(*) AS n_rows FROM (
    SELECT 'b0' AS batch_id, o_orderstatus AS data_type FROM orders
    UNION ALL SELECT 'b1', 'customer' FROM customer) GROUP BY ALL""")
def record_state(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string")
                                                   .alias("ticker"))
    held = state.record_state(order_state(spark, sf_dir), keys, "customer", "b1", CTX)
    return held.groupBy("batch_id", "data_type").agg(F.count(F.lit(1)).alias("n_rows"))


def watermark(spark, sf_dir):
    """Last order per customer as the watermark of one data type, plus rows of another."""
    last = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("ticker")).agg(
        F.max("o_orderdate").cast("timestamp").alias("updated_at"))
    held = key_state(spark, sf_dir).join(last, "ticker").select(
        "ticker", F.lit("quotes").alias("data_type"), "ticker_status", "updated_at")
    other = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ticker"), F.lit("other").alias("data_type"),
        F.lit("active").alias("ticker_status"), F.lit(T0).alias("updated_at"))
    return held.unionByName(other)


cte("x_watermark", """SELECT o_custkey AS ticker, 'quotes' AS data_type,
    CASE WHEN max(o_orderdate) < TIMESTAMP '2001-01-01' THEN 'inactive' ELSE 'active' END
    AS ticker_status, max(o_orderdate) AS updated_at FROM orders GROUP BY o_custkey""")
OTHERS = f"""SELECT s_suppkey AS ticker, 'other' AS data_type, 'active' AS ticker_status,
    {T0_SQL} AS updated_at FROM supplier"""


@query("sync_watermark", f"""{OTHERS} UNION ALL
    SELECT ticker, 'quotes', CASE WHEN k IS NULL THEN 'inactive' ELSE 'active' END,
    CASE WHEN u IS NULL OR bal > 5000 THEN TIMESTAMP '1993-01-01 00:00:00' ELSE u END
    FROM (SELECT c_custkey AS ticker, 1 AS k, c_acctbal AS bal FROM customer WHERE c_acctbal > 0)
    FULL JOIN (SELECT ticker, updated_at AS u FROM x_watermark) USING (ticker)""")
def sync_watermark(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "ticker")
    synced = state.sync_watermark(
        watermark(spark, sf_dir), customers.where("c_acctbal > 0"), "quotes",
        CTX.fallback_date, customers.where("c_acctbal > 5000"))
    return naive(synced, "updated_at")


@query("reconcile_watermark", f"""{OTHERS} UNION ALL
    SELECT w.ticker, 'quotes', w.ticker_status, coalesce(s.seen, w.updated_at)
    FROM x_watermark w LEFT JOIN (SELECT l_suppkey AS ticker, max(l_shipdate) AS seen
    FROM lineitem WHERE year(l_shipdate) >= 1998 GROUP BY 1) s ON w.ticker = s.ticker""")
def reconcile_watermark(spark, sf_dir):
    data = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("ticker"), F.year("l_shipdate").alias("year"),
        F.lit("quotes").alias("data_type"),
        F.col("l_shipdate").cast("timestamp").alias("bronze_ingested_time"))
    rebuilt = state.reconcile_watermark(watermark(spark, sf_dir), data, "quotes", CTX.today)
    return naive(rebuilt, "updated_at")


@query("start_date_lookup", """SELECT ticker, CAST(updated_at AS DATE) AS start_date
    FROM x_watermark WHERE ticker_status = 'active'""")
def start_date_lookup(spark, sf_dir):
    return state.start_dates(watermark(spark, sf_dir), "quotes")


AQ0 = "(year(start_date) * 4 + quarter(start_date))"
URL = "'https://api.example.com/symbols/' || ticker || "
DAYS = "date_diff('day', start_date, DATE '2001-03-31')"


@query("plan_tasks", f"""SELECT * FROM (
    SELECT ticker, 'balance_sheet_quarter' AS data_type, 2001 * 4 + 1 - {AQ0} + 2 AS fetch_limit,
        {URL} '/full-financial-reports?type=1&year=2001&quarter=1&limit='
        || (2001 * 4 + 1 - {AQ0} + 2) AS url
    FROM (SELECT ticker, CAST(updated_at AS DATE) AS start_date FROM x_watermark)
    UNION ALL SELECT ticker, 'income_statement_year', 2000 - year(start_date) + 1,
        {URL} '/full-financial-reports?type=2&year=2000&quarter=0&limit='
        || (2000 - year(start_date) + 1)
    FROM (SELECT ticker, CAST(updated_at AS DATE) AS start_date FROM x_watermark)
    UNION ALL SELECT ticker, 'historical_quotes', n, {URL} '/historical-quotes?startDate='
        || start_date || '&endDate=2001-03-31&offset=0&limit=' || n
    FROM (SELECT ticker, start_date, CAST(floor({DAYS} * (CAST(250 AS DOUBLE) / 365)) AS BIGINT)
          + 20 AS n FROM (SELECT ticker, CAST(updated_at AS DATE) AS start_date FROM x_watermark)
          WHERE {DAYS} >= 0)
    UNION ALL SELECT ticker, 'dividend', 2001 - year(start_date) + 1,
        {URL} '/dividends?count=' || (2001 - year(start_date) + 1)
    FROM (SELECT ticker, CAST(updated_at AS DATE) AS start_date FROM x_watermark)
    ) WHERE fetch_limit > 0""")
def plan_tasks(spark, sf_dir):
    from dataclasses import replace

    ctx = replace(CTX, as_of=date(2001, 4, 1))
    starts = watermark(spark, sf_dir).where("data_type = 'quotes'").select(
        "ticker", F.to_date("updated_at").alias("start_date"))
    plans = [("quarter_report", "balance_sheet_quarter", "balance_sheet"),
             ("year_report", "income_statement_year", "income_statement"),
             ("historical_quotes", "historical_quotes", None), ("dividend", "dividend", None)]
    parts = None
    for kind, data_type, report in plans:
        rows = state.plan_tasks(starts, kind, data_type, ctx, "suite", report).select(
            "ticker", "data_type", "fetch_limit", "url")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts
