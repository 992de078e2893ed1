"""The driver's tables mapped to the engine's landing tables.

One supplier is one company.  Its line items give quarterly report values and daily prices,
so every derived table grows with the line items.  ``suite.inputs_sql`` states the same
mapping in SQL.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factorloom.context import RunContext

# Run settings of the suite: the tables' dates end on 2001-11-04.
STARTED = datetime(2001, 11, 9, 6, 0, 0, tzinfo=timezone.utc)
FIRST_DELIVERY = "2001-11-05 00:00:00"
SECOND_DELIVERY = "2001-11-06 00:00:00"
STALE_DELIVERY = "2001-10-30 00:00:00"
# Base-36 digits of a company key: two thousand million suppliers.
KEY_WIDTH = 6
KEY_PATTERN = f"^[A-Z0-9]{{{KEY_WIDTH}}}$"
CTX = RunContext(run_id="suite", started_at=STARTED, as_of=date(2001, 11, 10), min_year=1995,
                 ticker_pattern=KEY_PATTERN)
MIN_VOLUME = 10_000

# Report value = rev_factor * revenue + cost_factor * costs (data type, id, both factors).
INDICATORS = """
income_statement_quarter    1        1      0
income_statement_quarter    2        0      0
income_statement_quarter    3        1      0
income_statement_quarter    4        0      1
income_statement_quarter    5        1     -1
income_statement_quarter    11       1     -1
income_statement_quarter    15       1     -1
income_statement_quarter    16       0.2   -0.2
income_statement_quarter    18       0.2   -0.2
income_statement_quarter    19       0.8   -0.8
income_statement_quarter    21       0.8   -0.8
balance_sheet_quarter       2        4      0
balance_sheet_quarter       4        4      0
balance_sheet_quarter       101      1.5    0
balance_sheet_quarter       102      2.5    0
balance_sheet_quarter       301      1.6    0
balance_sheet_quarter       302      2.4    0
balance_sheet_quarter       30101    1      0
balance_sheet_quarter       30102    0.6    0
balance_sheet_quarter       10101    0.2    0
balance_sheet_quarter       3010101  0.3    0
balance_sheet_quarter       3010206  0.4    0
balance_sheet_quarter       3020111  0.5    0
balance_sheet_quarter       3020114  0.05   0
cash_flow_indirect_quarter  104      0.3    0
cash_flow_indirect_quarter  212     -0.1    0
cash_flow_indirect_quarter  311     -0.05   0
cash_flow_indirect_quarter  4        0.15   0
cash_flow_indirect_quarter  5        0.1    0
cash_flow_indirect_quarter  7        0.25   0
cash_flow_indirect_quarter  10201    0.05   0
cash_flow_indirect_quarter  201      0      0.08
"""
INDICATOR_ROWS = [line.split() for line in INDICATORS.strip().splitlines()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticker_of(key: str) -> Column:
    """Base-36 code of a key, of fixed width; no two keys share one."""
    return F.lpad(F.conv(F.col(key).cast("string"), 10, 36), KEY_WIDTH, "0")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Keep every core busy where few small rows are about to become many.

    Adaptive execution merges small shuffle partitions, which would leave the expansion that
    follows to one task; a fixed partition count is not merged.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, costs and line count per company and quarter."""
    lines = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    day = F.to_date("l_shipdate")
    sums = lines.groupBy(
        "l_suppkey", F.year(day).alias("year"), F.quarter(day).alias("quarter")
    ).agg(
        F.sum(price).cast("decimal(20,2)").alias("rev"),
        F.coalesce(F.sum(F.when(F.col("l_linestatus") == "F", price)), F.lit(0))
        .cast("decimal(20,2)").alias("costs"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    return sums.withColumn("ticker", ticker_of("l_suppkey"))


def deliveries(spark: SparkSession, sf_dir: str, per_quarter: DataFrame | None = None) -> DataFrame:
    """Every cell once, and for even suppliers again a day later with 1 % higher revenue.

    ``per_quarter`` are the ``cells``, if they are stored already.
    """
    first = F.struct(_ts(FIRST_DELIVERY).alias("bronze_ingested_time"),
                     F.col("rev").alias("rev"))
    raised = (F.col("rev") * F.lit("1.01").cast("decimal(4,2)")).cast("decimal(20,2)")
    second = F.struct(_ts(SECOND_DELIVERY).alias("bronze_ingested_time"), raised.alias("rev"))
    again = F.when(F.col("l_suppkey") % 2 == 0, F.array(first, second)).otherwise(F.array(first))
    found = cells(spark, sf_dir) if per_quarter is None else per_quarter
    rows = found.withColumn("_d", F.explode(again))
    return rows.drop("rev").select("*", "_d.*").drop("_d")


def reports(spark: SparkSession, sf_dir: str, per_quarter: DataFrame | None = None) -> DataFrame:
    """Landing rows of the quarterly statements.

    Suppliers 7, 32, ... break the gross-profit identity in quarter 3; suppliers 9, 34, ...
    deliver no cash flow in quarter 2 of 1996.
    """
    breaks = "l_suppkey % 25 = 7 AND quarter = 3"

    items = ", ".join(
        f"struct('{kind}' AS data_type, {i} AS indicator_id, CAST({a} AS DECIMAL(4,2)) AS a,"
        f" CAST({b} AS DECIMAL(4,2)) AS b)" for kind, i, a, b in INDICATOR_ROWS
    )
    exact = "a * rev + b * costs"
    broken = f"data_type = 'income_statement_quarter' AND indicator_id = 5 AND {breaks}"
    value = (f"CAST(CASE WHEN {broken} THEN CAST(({exact}) * 1.1 AS DECIMAL(28,4))"
             f" ELSE CAST({exact} AS DECIMAL(28,4)) END AS DOUBLE) AS value")
    rows = spread(deliveries(spark, sf_dir, per_quarter), "ticker").selectExpr(
        "l_suppkey", "ticker", "year", "quarter", "bronze_ingested_time", "rev", "costs",
        f"inline(array({items}))").selectExpr(
        "l_suppkey", "ticker", "year", "quarter", "bronze_ingested_time", "data_type",
        "indicator_id", value)
    lost = ((F.col("l_suppkey") % 25 == 9) & (F.col("quarter") == 2) & (F.col("year") == 1996)
            & (F.col("data_type") == "cash_flow_indirect_quarter"))
    return rows.where(~lost).drop("l_suppkey")


def fundamental_quarters(spark: SparkSession, sf_dir: str,
                         per_quarter: DataFrame | None = None) -> DataFrame:
    """Quarterly market data as JSON documents; every 40th supplier reports no market value."""
    cap = F.when(F.col("l_suppkey") % 40 != 39, F.col("rev") * 3).cast("decimal(22,2)")
    doc = F.to_json(F.struct(
        cap.alias("MarketCapAtPeriodEnd"),
        (F.col("n_lines") * 1000).alias("ShareAtPeriodEnd"),
        F.lit(0).alias("PreferredStock"),
    ))
    return deliveries(spark, sf_dir, per_quarter).select(
        "ticker", "year", "quarter", doc.alias("value"), "bronze_ingested_time")


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per quarter with any shipment."""
    day = F.to_date("l_shipdate")
    quarters = table(spark, sf_dir, "lineitem").select(
        F.year(day).alias("year"), F.quarter(day).alias("quarter")).distinct()
    index = (F.col("year") * 4 + F.col("quarter")).cast("bigint")
    return quarters.select(
        "year", "quarter", index.alias("absolute_quarter"),
        (F.lit(2.0) + (index % 7) * F.lit(0.3)).alias("risk_free_rate"),
        (F.lit(100.0) + (index - 7981) * F.lit(0.5)).alias("cpi_index"),
    )


def company_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company rows with repeats: every 5th supplier again without a name, every 50th in a
    lower-case form that no rule accepts."""
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    base = suppliers.join(nations, "n_nationkey").select(
        "s_suppkey", ticker_of("s_suppkey").alias("ticker"),
        F.col("s_name").alias("company_name"), F.col("r_name").alias("industry_group"),
        F.col("n_name").alias("sector_detail"),
        F.when(F.col("s_suppkey") % 8 == 0, "NH").otherwise("CT").alias("company_type"),
    )
    names = ("ticker", "company_name", "industry_group", "sector_detail", "company_type")

    def row(ticker: Column, name: Column) -> Column:
        return F.struct(ticker.alias("ticker"), name.alias("company_name"),
                        *[F.col(c) for c in names[2:]])

    plain = row(F.col("ticker"), F.col("company_name"))
    unnamed = row(F.col("ticker"), F.lit(None).cast("string"))
    lower = row(F.concat(F.lower("ticker"), F.lit("x")), F.col("company_name"))
    rows = F.concat(
        F.array(plain),
        F.when(F.col("s_suppkey") % 5 == 0, F.array(unnamed)).otherwise(F.array()),
        F.when(F.col("s_suppkey") % 50 == 0, F.array(lower)).otherwise(F.array()),
    )
    return base.select(F.explode(rows).alias("_r")).select("_r.*")


def fundamentals_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company documents; every 3rd supplier also has a stale one that must be left out."""
    volume = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").cast("double").alias("vol"), F.count(F.lit(1)).alias("n"))
    rows = table(spark, sf_dir, "supplier").join(
        volume, F.col("s_suppkey") == F.col("l_suppkey"))

    def doc(scale: int) -> Column:
        return F.to_json(F.struct(
            (F.round((F.col("s_acctbal") + 1000) * 100).cast("bigint") * 2_000_000 * scale)
            .alias("marketCap"),
            (F.col("vol").cast("bigint") * scale).alias("avgVolume3m"),
            (F.col("n") * 1000).alias("sharesOutstanding"),
            (F.col("n") * 600).alias("freeShares"),
        ))

    def delivery(at: str, scale: int) -> Column:
        return F.struct(_ts(at).alias("bronze_ingested_time"), doc(scale).alias("data"))

    now, stale = delivery(FIRST_DELIVERY, 1), delivery(STALE_DELIVERY, 3)
    both = F.when(F.col("s_suppkey") % 3 == 0, F.array(now, stale)).otherwise(F.array(now))
    padded = F.concat(F.lit(" "), F.lower(ticker_of("s_suppkey")))
    return rows.select(padded.alias("ticker"), F.explode(both).alias("_d")).select(
        "ticker", "_d.*")


def fundamentals_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange documents; every 13th supplier has none, every 17th an unknown venue."""
    venues = F.array(*[F.lit(v) for v in ("HSX", "HOSE", "HNX", "UPCOM")])
    exchange = F.when(F.col("s_suppkey") % 17 == 16, "OTC").otherwise(
        F.element_at(venues, (F.col("s_nationkey") % 4 + 1).cast("int")))
    doc = F.to_json(F.struct(exchange.alias("exchange"),
                             (F.col("s_suppkey") % 11 != 10).alias("isListing")))
    return table(spark, sf_dir, "supplier").where("s_suppkey % 13 <> 12").select(
        ticker_of("s_suppkey").alias("ticker"), doc.alias("data"),
        _ts(FIRST_DELIVERY).alias("bronze_ingested_time"))


# A nation's days are broadcast up to so many rows; from so many company days a task on, tasks
# are not merged.
BROADCAST_ROWS, TASK_ROWS = 1 << 18, 100_000


def price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and volume per company for every day its nation trades, plus the index.

    A company's price is its own mean unit price of the day, else its nation's.  Companies, their
    lines and the index move to their tickers by one exchange, as narrow rows; a company's days
    are made where it has come to, beside its lines, so they are never moved.
    """
    day = F.to_date("l_shipdate")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", day.alias("date"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("ext"),
        F.col("l_quantity").cast("decimal(18,2)").alias("qty"))

    def sums(rows: DataFrame, keys: list[str], prefix: str) -> DataFrame:
        # exact sums, as doubles before they spread over all companies and days
        return rows.groupBy(*keys).agg(*[
            F.sum(c).cast("double").alias(f"{prefix}{c}") for c in ("ext", "qty")])

    nation = sums(lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")),
                  ["s_nationkey", "date"], "all_").withColumnRenamed("s_nationkey", "n_nationkey")
    companies = suppliers.where("s_nationkey IS NOT NULL").select(
        ticker_of("s_suppkey").alias("ticker"), "s_nationkey")
    own = lines.where("l_suppkey IS NOT NULL AND date IS NOT NULL").select(
        ticker_of("l_suppkey").alias("ticker"), "date", "ext", "qty", F.lit(True).alias("line"))
    index = sums(lines, ["date"], "all_").withColumn("ticker", F.lit(CTX.benchmark))

    def beside(*frames: DataFrame) -> DataFrame:
        return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)

    home = F.col("s_nationkey") == F.col("n_nationkey")
    most = BROADCAST_ROWS + 1
    calendar = lines.select("date").distinct().limit(most).count()
    nations = companies.select("s_nationkey").distinct().limit(most).count()
    if calendar * nations <= BROADCAST_ROWS:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        moved = beside(companies, own, index)
        moved = (moved.repartition(parts, "ticker")
                 if calendar * companies.count() >= parts * TASK_ROWS
                 else moved.repartition("ticker"))
        filled = [c for c in nation.columns if c != "n_nationkey"]
        rows = moved.alias("l").join(F.broadcast(nation).alias("r"), home, "left").where(
            "s_nationkey IS NULL OR n_nationkey IS NOT NULL").select(
            "ticker", "ext", "qty", "line",
            *[F.coalesce(f"r.{c}", f"l.{c}").alias(c) for c in filled])
    else:
        rows = beside(companies.join(nation, home), own, index).repartition("ticker")
    same_day = W.partitionBy("ticker", "date")
    days = rows.select("ticker", "date", "line", *[
        F.coalesce(F.sum(c).over(same_day).cast("double"), f"all_{c}").alias(c)
        for c in ("ext", "qty")]).where("line IS NULL")
    unit = F.floor(F.col("ext") * 100 / F.col("qty")) / 100
    priced = days.select(
        "ticker", "date", unit.cast("decimal(20,4)").alias("price_close"),
        F.col("qty").alias("total_volume"))
    previous = F.lag("price_close").over(W.partitionBy("ticker").orderBy("date"))
    return priced.withColumn("price_basic", previous)


def quotes_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price days as landed JSON documents."""
    doc = F.to_json(F.struct(
        F.col("price_basic").alias("priceBasic"), F.col("price_close").alias("priceClose"),
        F.col("total_volume").alias("totalVolume")))
    return price_days(spark, sf_dir).select(
        "ticker", F.year("date").alias("year"), F.col("date").alias("event_date"),
        doc.alias("data"), _ts(FIRST_DELIVERY).alias("bronze_ingested_time"))


def dividends_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part brands as companies, part sizes as years."""
    brand = F.regexp_extract("p_brand", r"(\d+)", 1)
    cents = F.sum(F.col("p_retailprice").cast("decimal(18,2)"))
    rows = table(spark, sf_dir, "part").groupBy(
        F.concat(F.lit("B"), F.lpad(brand, 2, "0")).alias("ticker"),
        (F.lit(1994) + F.col("p_size") % 8).cast("int").alias("year"),
    ).agg(cents.alias("cash"), F.count(F.lit(1)).alias("n"))
    doc = F.to_json(F.struct(
        F.when(F.col("n") % 7 == 0, -F.col("cash")).otherwise(F.col("cash")).alias("cashDividend"),
        F.lit(0).alias("stockDividend")))
    return rows.select("ticker", "year", doc.alias("data"),
                       _ts(FIRST_DELIVERY).alias("bronze_ingested_time"))
