"""Scans, sinks, stored tables and payload reshaping."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from factorloom.catalogue import TABLES, TableSpec
from factorloom.operators import reshape
from factorloom.operators.clean import with_audit
from factorloom.session import scratch_path
from factorloom.sources import store, tables
from suite import inputs
from suite.inputs import CTX, table
from suite.models import models
from suite.registry import query


def new_store(spark) -> store.Warehouse:
    return store.Warehouse(spark, scratch_path(spark, "tables"))


@query("scan_table", """SELECT c_custkey, c_acctbal FROM customer
    WHERE c_mktsegment = 'BUILDING'""")
def scan_table(spark, sf_dir):
    return tables.scan_table(spark, f"{sf_dir}/customer.parquet", ["c_custkey", "c_acctbal"],
                             F.col("c_mktsegment") == "BUILDING")


@query("scan_seed_csv", """SELECT year, quarter, CAST(absolute_quarter AS INT)
    AS absolute_quarter, risk_free_rate, cpi_index FROM x_macro""")
def scan_seed_csv(spark, sf_dir):
    path = scratch_path(spark, "seed")
    inputs.macro(spark, sf_dir).write.csv(path, header=True)
    return tables.scan_seed_csv(spark, path, tables.MACRO_SCHEMA)


@query("scan_distinct_keys", """SELECT 'all' AS mode, ticker FROM x_companies
    UNION ALL SELECT 'qualified', ticker FROM x_dim WHERE status = 'qualified'
    UNION ALL SELECT 'benchmark', 'VNINDEX'""")
def scan_distinct_keys(spark, sf_dir):
    chain = models(spark, sf_dir)
    sources = {"all": chain.companies(), "qualified": chain.dim_company(), "benchmark": None}
    parts = None
    for mode, df in sources.items():
        keys = tables.entity_list(spark, mode, df, CTX.benchmark)
        rows = keys.select(F.lit(mode).alias("mode"), "ticker")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query("table_registry", """SELECT year, data_type, count(*) AS n_rows,
    count(DISTINCT ticker) AS n_tickers, max(indicator_id) AS max_id
    FROM x_reports GROUP BY year, data_type""")
def table_registry(spark, sf_dir):
    held = new_store(spark)
    spec = TABLES["financial_reports_quarter"]
    held.create(spec)
    held.append(inputs.reports(spark, sf_dir), spec)
    return held.read(spec.name).groupBy("year", "data_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ticker").alias("n_tickers"),
        F.max("indicator_id").alias("max_id"))


ORDERS = TableSpec("orders_landing", "o_orderkey bigint, o_custkey bigint,"
                   " o_orderstatus string, o_totalprice double", ("o_orderstatus",),
                   ("o_orderkey",))


@query("sink_append_evolve", """SELECT o_orderstatus, count(*) AS n_rows,
    round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 2)::DOUBLE AS total,
    count(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END) AS n_priority
    FROM orders GROUP BY o_orderstatus""")
def sink_append_evolve(spark, sf_dir):
    held = new_store(spark)
    orders = table(spark, sf_dir, "orders")
    old = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    done = F.col("o_orderstatus") == "F"
    held.append(orders.where(done).select(*old), ORDERS)
    held.append(orders.where(~done).select(*old, "o_orderpriority"), ORDERS)
    return held.read(ORDERS.name).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        F.count("o_orderpriority").alias("n_priority"))


@query("sink_overwrite", """SELECT o_orderstatus, count(*) AS n_rows FROM orders
    WHERE o_totalprice > 100000 GROUP BY o_orderstatus""")
def sink_overwrite(spark, sf_dir):
    held = new_store(spark)
    held.replace(table(spark, sf_dir, "orders"), ORDERS)
    held.replace(held.read(ORDERS.name).where("o_totalprice > 100000"), ORDERS)
    return held.read(ORDERS.name).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("sink_atomic_swap", "SELECT s_suppkey, s_name, s_acctbal * 2 AS s_acctbal FROM supplier")
def sink_atomic_swap(spark, sf_dir):
    held = new_store(spark)
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    held.swap(suppliers, "serving", ("s_suppkey",))
    doubled = held.read("serving").withColumn("s_acctbal", F.col("s_acctbal") * 2)
    held.swap(doubled, "serving", ("s_suppkey",))
    return held.read("serving")


@query("sink_csv_export", """SELECT n_nationkey, n_name, r_name FROM nation
    JOIN region ON n_regionkey = r_regionkey""")
def sink_csv_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    store.export_csv(nations.select("n_nationkey", "n_name", "r_name"), path, ["n_nationkey"])
    return spark.read.csv(path, header=True,
                          schema="n_nationkey int, n_name string, r_name string")


@query("seed_backup_export", """SELECT ticker, company_name, industry_group, sector_detail,
    company_type FROM x_companies""")
def seed_backup_export(spark, sf_dir):
    path = scratch_path(spark, "backup")
    store.export_seed(with_audit(models(spark, sf_dir).companies(), "silver", CTX), path)
    names = "ticker company_name industry_group sector_detail company_type".split()
    return spark.read.csv(path, header=True, schema=", ".join(f"{n} string" for n in names))


@query("partition_retention", """SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-20' GROUP BY 1""")
def partition_retention(spark, sf_dir):
    held = new_store(spark)
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    spec = TableSpec("audit", "", ("day",), ("ts",))
    held.append(events, spec)
    held.expire("audit", "day", date(2024, 1, 30), 10)
    return held.read("audit").groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"))


@query("compact_files", """SELECT count(*) AS n_rows, max(event_id) AS max_id,
    TRUE AS fewer_files FROM events""")
def compact_files(spark, sf_dir):
    held = new_store(spark)
    spec = TableSpec("small", "", (), ("ts",))
    held.replace(table(spark, sf_dir, "events").repartition(16), spec)
    before = held.file_count("small")
    held.compact(spec)
    fewer = held.file_count("small") < before
    return held.read("small").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("event_id").alias("max_id")
    ).withColumn("fewer_files", F.lit(fewer))


def _fresh_sql(name: str, source: str, column: str, warn: int, error: int) -> str:
    age = f"date_sub('second', max({column}), TIMESTAMP '2001-12-20 00:00:00')"
    return (f"SELECT '{name}' AS table_name, max({column}) AS max_loaded_at, {age} AS age_seconds,"
            f" CASE WHEN {age} > {error * 86400} THEN 'error' WHEN {age} > {warn * 86400}"
            f" THEN 'warn' ELSE 'pass' END AS status FROM {source}")


@query("source_freshness", " UNION ALL ".join((
    _fresh_sql("historical_quotes", "lineitem", "l_shipdate", 30, 60),
    _fresh_sql("fundamental_1", "orders", "o_orderdate", 35, 60),
    _fresh_sql("dividend_year", "events", "ts", 365, 400))))
def source_freshness(spark, sf_dir):
    loaded = {"historical_quotes": ("lineitem", "l_shipdate"),
              "fundamental_1": ("orders", "o_orderdate"), "dividend_year": ("events", "ts")}
    frames = {
        name: table(spark, sf_dir, t).select(F.col(c).alias("bronze_ingested_time"))
        for name, (t, c) in loaded.items()
    }
    out = tables.freshness(frames, datetime(2001, 12, 20, tzinfo=timezone.utc))
    return out.withColumn("max_loaded_at", F.col("max_loaded_at").cast("timestamp_ntz"))


# Payload reshaping: the payload of an order message lists its measures ----------------------

def messages(spark, sf_dir):
    """One message per order; orders in progress carry an empty list."""
    measure = "struct('{0}' AS metric, {1} AS amount)"
    items = f"array({measure.format('price', 'o_totalprice')}," \
            f" {measure.format('customer', 'CAST(o_custkey AS DOUBLE)')})"
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"CASE WHEN o_orderstatus = 'P' THEN slice({items}, 1, 0)"
                      f" ELSE {items} END AS data")


@query("explode_records", """SELECT o_orderkey, 'price' AS metric, o_totalprice AS amount
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, 'customer', CAST(o_custkey AS DOUBLE) FROM orders
    WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderstatus = 'P'""")
def explode_records(spark, sf_dir):
    rows = reshape.explode_records(messages(spark, sf_dir))
    return rows.select("o_orderkey", "data.metric", "data.amount")


@query("unnest_struct", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def unnest_struct(spark, sf_dir):
    packed = table(spark, sf_dir, "customer").select(
        "c_custkey", F.struct("c_name", "c_acctbal").alias("data"))
    return reshape.unnest_struct(packed)


def order_payloads(spark, sf_dir, record):
    """One nested payload per order, its lines as records."""
    return table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate")).groupBy(
        F.col("l_orderkey").cast("string").alias("ticker")).agg(
        F.collect_list(record).alias("data"))


def json_number(column: str, field: str):
    return F.get_json_object(column, f"$.{field}").cast("double").alias(field)


@query("flatten_quotes", """SELECT CAST(l_orderkey AS VARCHAR) AS ticker,
    CAST(l_shipdate AS DATE) AS event_date, CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(l_extendedprice AS DOUBLE) AS priceClose, CAST(l_quantity AS DOUBLE) AS totalVolume
    FROM lineitem""")
def flatten_quotes(spark, sf_dir):
    payload = order_payloads(spark, sf_dir, F.struct(
        F.date_format("day", "yyyy-MM-dd'T'00:00:00").alias("date"),
        F.col("l_extendedprice").alias("priceClose"), F.col("l_quantity").alias("totalVolume")))
    return reshape.flatten_quotes(payload, CTX).select(
        "ticker", "event_date", "year", json_number("data", "priceClose"),
        json_number("data", "totalVolume"))


@query("flatten_fundamental_quarter", """SELECT CAST(l_orderkey AS VARCHAR) AS ticker,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
    CAST(l_extendedprice AS DOUBLE) AS MarketCapAtPeriodEnd FROM lineitem""")
def flatten_fundamental_quarter(spark, sf_dir):
    payload = order_payloads(spark, sf_dir, F.struct(
        F.year("day").cast("string").alias("year"), F.quarter("day").cast("string")
        .alias("quarter"), F.struct(F.col("l_extendedprice").alias("MarketCapAtPeriodEnd"))
        .alias("financialValues")))
    return reshape.flatten_fundamental_quarter(payload, CTX).select(
        "ticker", "year", "quarter", json_number("value", "MarketCapAtPeriodEnd"))


@query("flatten_dividends", """SELECT CAST(l_orderkey AS VARCHAR) AS ticker,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_discount AS DOUBLE) AS amount
    FROM lineitem""")
def flatten_dividends(spark, sf_dir):
    payload = order_payloads(spark, sf_dir, F.struct(
        F.year("day").alias("year"), F.col("l_discount").alias("amount")))
    return reshape.flatten_dividends(payload, CTX).select(
        "ticker", "year", json_number("data", "amount"))


@query("flatten_two_level", """SELECT o_orderkey, CAST(i AS INT) AS indicator_id,
    CASE i WHEN 1 THEN 'price' ELSE 'customer' END AS indicator_name,
    CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter,
    CASE WHEN i = 1 THEN o_totalprice * k ELSE CAST(o_custkey AS DOUBLE) * k END AS value
    FROM orders CROSS JOIN (VALUES (1), (2)) AS a(i) CROSS JOIN (VALUES (1), (2)) AS b(k)""")
def flatten_two_level(spark, sf_dir):
    def values(amount: str) -> str:
        one = "struct(year(o_orderdate) AS year, quarter(o_orderdate) AS quarter," \
              " {0} * {1} AS value)"
        return f"array({one.format(amount, 1)}, {one.format(amount, 2)})"

    payload = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        f"array(struct(1 AS id, 'price' AS name, {values('o_totalprice')} AS values),"
        f" struct(2 AS id, 'customer' AS name, {values('CAST(o_custkey AS DOUBLE)')} AS values))"
        " AS data")
    return reshape.flatten_reports(payload)


@query("struct_to_json", """SELECT p_partkey, '{"size":' || p_size || ',"brand":"' || p_brand
    || '"}' AS doc FROM part""")
def struct_to_json(spark, sf_dir):
    packed = table(spark, sf_dir, "part").select(
        "p_partkey", F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))
        .alias("doc"))
    return reshape.struct_to_json(packed, "doc")


@query("payload_to_json", """SELECT p_partkey, '[{"v":' || p_size || '},{"v":' || (p_size + 1)
    || '}]' AS data FROM part""")
def payload_to_json(spark, sf_dir):
    packed = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "array(struct(p_size AS v), struct(p_size + 1 AS v)) AS data")
    return reshape.payload_to_json(packed)


@query("field_from_struct", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date,
    CAST(year(o_orderdate) AS INT) AS year FROM orders""")
def field_from_struct(spark, sf_dir):
    packed = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "struct(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS date,"
                      " o_totalprice AS price) AS data")
    return reshape.with_event_date(packed).drop("data")


@query("parse_iso_ts", """SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END
    AS parsed FROM events""")
def parse_iso_ts(spark, sf_dir):
    text = table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_type = 'error' THEN 'no time' ELSE"
                    " date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") END AS text")
    return text.select("event_id", reshape.parse_iso_ts("text").cast("timestamp_ntz")
                       .alias("parsed"))


@query("stamp_ingest_time", """SELECT '2001-11-09 06:00:00' AS stamped, count(*) AS n_rows
    FROM orders""")
def stamp_ingest_time(spark, sf_dir):
    stamped = reshape.stamp_ingest_time(table(spark, sf_dir, "orders"), CTX)
    return stamped.groupBy(F.col("bronze_ingested_time").cast("string").alias("stamped")).agg(
        F.count(F.lit(1)).alias("n_rows"))


