"""Data tests and monitoring tables."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.catalogue import STATEMENTS
from factorloom.operators import datatests, observe
from factorloom.operators.checks import Check, compiled
from factorloom.operators.clean import with_audit
from factorloom.plans.declared import checks_of
from suite import inputs
from suite.inputs import CTX, table
from suite.models import models
from suite.q_incremental import naive
from suite.q_relational import metrics, runs
from suite.registry import query, rounded, rs

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)


# Assertions --------------------------------------------------------------------------------

@query("test_not_null", "SELECT ticker, year, quarter FROM x_fq_latest WHERE market_cap IS NULL")
def test_not_null(spark, sf_dir):
    rows = models(spark, sf_dir).fundamental_quarter()
    asked = rows.where("unqualified_reason IS NOT NULL OR market_cap > 0").withColumn(
        "market_cap", F.when(F.col("market_cap") > 0, F.col("market_cap")))
    return datatests.not_null(asked, "market_cap").select("ticker", "year", "quarter")


@query("test_unique", """SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey
    HAVING count(*) > 1""")
def test_unique(spark, sf_dir):
    return datatests.unique(table(spark, sf_dir, "orders"), "o_custkey")


@query("test_accepted_values", """SELECT event_type, count(*) AS n_rows FROM events
    WHERE event_type NOT IN ('view', 'click') GROUP BY event_type""")
def test_accepted_values(spark, sf_dir):
    return datatests.accepted_values(table(spark, sf_dir, "events"), "event_type",
                                     ["view", "click"])


@query("test_relationships", """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'
    AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def test_relationships(spark, sf_dir):
    rows = datatests.relationships(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_acctbal > 0"),
        "o_custkey", "c_custkey", F.col("o_orderstatus") == "F")
    return rows.select("o_orderkey", "o_custkey")


@query("test_regex", """SELECT ticker, company_name FROM x_company_list
    WHERE NOT regexp_matches(ticker, '^[A-Z0-9]{6}$') AND company_type = 'NH'""")
def test_regex(spark, sf_dir):
    rows = datatests.regex(inputs.company_list(spark, sf_dir), "ticker", inputs.KEY_PATTERN,
                           F.col("company_type") == "NH")
    return rows.select("ticker", "company_name")


@query("test_between", "SELECT p_partkey, p_size FROM part WHERE p_size < 5 OR p_size > 45")
def test_between(spark, sf_dir):
    rows = datatests.between(table(spark, sf_dir, "part"), "p_size", 5, 45)
    return rows.select("p_partkey", "p_size")


@query("test_in_set", """SELECT p_partkey FROM part WHERE p_size NOT IN (1, 2, 3)
    AND p_retailprice > 950""")
def test_in_set(spark, sf_dir):
    rows = datatests.in_set(table(spark, sf_dir, "part"), "p_size", [1, 2, 3],
                            F.col("p_retailprice") > 950)
    return rows.select("p_partkey")


@query("test_not_null_if", """SELECT ticker FROM x_dim WHERE company_type = 'CT'
    AND exchange IS NULL""")
def test_not_null_if(spark, sf_dir):
    rows = datatests.not_null(models(spark, sf_dir).dim_company(), "exchange",
                              F.col("company_type") == "CT")
    return rows.select("ticker")


@query("test_null_if", """SELECT ticker FROM x_dim WHERE company_type = 'NH'
    AND gold_unqualified_reason IS NOT NULL""")
def test_null_if(spark, sf_dir):
    rows = datatests.null_if(models(spark, sf_dir).dim_company(), "gold_unqualified_reason",
                             F.col("company_type") == "NH")
    return rows.select("ticker")


@query("test_compound_unique", """SELECT o_custkey, o_orderstatus, count(*) AS n_rows FROM orders
    GROUP BY ALL HAVING count(*) > 1""")
def test_compound_unique(spark, sf_dir):
    return datatests.compound_unique(table(spark, sf_dir, "orders"),
                                     ["o_custkey", "o_orderstatus"])


@query("test_columns_contain", """SELECT * FROM (VALUES
    ('columns_o_orderkey_o_comment', CAST(1 AS BIGINT), 'fail'),
    ('columns_o_orderkey_o_custkey', 0, 'pass')) AS v(test_name, failures, status)
    UNION ALL SELECT 'unique_o_orderkey', count(o_orderkey) - count(DISTINCT o_orderkey), 'pass'
    FROM orders""")
def test_columns_contain(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    results = compiled(orders, [Check("columns", ("o_orderkey", "o_comment")),
                                Check("columns", ("o_orderkey", "o_custkey")),
                                Check("unique", ("o_orderkey",))], "orders")
    return results.select("test_name", "failures", "status")


@query("test_row_count_between", """SELECT * FROM (SELECT count(*) AS n_rows FROM lineitem)
    WHERE n_rows NOT BETWEEN 1000 AND 2000""")
def test_row_count_between(spark, sf_dir):
    return datatests.row_count_between(table(spark, sf_dir, "lineitem"), 1000, 2000)


@query("test_distinct_count", """SELECT * FROM (SELECT count(DISTINCT event_type) AS n_distinct
    FROM events) WHERE n_distinct <> 4""")
def test_distinct_count(spark, sf_dir):
    return datatests.distinct_count(table(spark, sf_dir, "events"), "event_type", 4)


@query("test_pair_greater", """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE NOT l_discount >= l_tax""")
def test_pair_greater(spark, sf_dir):
    rows = datatests.pair_greater(table(spark, sf_dir, "lineitem"), "l_discount", "l_tax")
    return rows.select("l_orderkey", "l_linenumber")


@query("test_recent", """SELECT * FROM (SELECT max(o_orderdate) AS max_timestamp FROM orders
    WHERE o_orderdate <= TIMESTAMP '2024-01-31')
    WHERE max_timestamp < TIMESTAMP '2023-12-30'""")
def test_recent(spark, sf_dir):
    return naive(datatests.recent(table(spark, sf_dir, "orders"), "o_orderdate", AS_OF),
                 "max_timestamp")


@query("null_rate", """SELECT CAST(count(CASE WHEN market_cap IS NULL THEN 1 END) * 10000
    // count(*) AS INT) AS failure_bps FROM x_fundq""")
def null_rate(spark, sf_dir):
    from factorloom.plans.cleaned import stage_fundamental_quarter

    staged = stage_fundamental_quarter(inputs.fundamental_quarters(spark, sf_dir), CTX)
    return datatests.null_rate(staged, "market_cap")


@query("invalid_rate", """SELECT CAST(count(CASE WHEN status = 'unqualified' THEN 1 END) * 10000
    // count(*) AS INT) AS failure_bps FROM x_is""")
def invalid_rate(spark, sf_dir):
    rows = models(spark, sf_dir).statement("income_statement")
    return datatests.invalid_rate(rows, "status", "unqualified")


def _cell(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value).upper() if isinstance(value, bool) else str(value)


def _failures(check: Check) -> str:
    """The SQL for a check's failures in a table ``t``."""
    c, values = check.columns[0], check.values
    only = f"({check.where}) AND " if check.where else ""
    rows = {
        "not_null": f"{c} IS NULL", "null": f"{c} IS NOT NULL",
        "in_set": f"{c} NOT IN ({', '.join(map(_cell, values))})",
        "regex": f"NOT regexp_matches({c}, {_cell(values[0])})" if values else "",
        "between": " OR ".join(f"{c} {op} {v}" for op, v in zip("<>", values) if v is not None),
    }
    if check.kind in rows:
        return f"count(*) FILTER (WHERE {only}({rows[check.kind]}))"
    if check.kind == "relationship":
        return (f"count(*) FILTER (WHERE {only}{c} IS NOT NULL AND {c} NOT IN "
                f"(SELECT {values[1]} FROM {PARENTS[values[0]]}))")
    if check.kind == "unique":
        key = " || '/' || ".join(f"CAST({k} AS VARCHAR)" for k in check.columns)
        return f"count({key}) - count(DISTINCT {key})"
    if check.kind == "rate":
        return f"count(*) FILTER (WHERE {c} = {_cell(values[0])}) * 10000 // count(*)"
    if check.kind == "distinct_count":
        return f"CASE WHEN count(DISTINCT {c}) = {values[0]} THEN 0 ELSE 1 END"
    if check.kind == "recent":
        return (f"CASE WHEN max({c}) >= TIMESTAMP '{CTX.started_at:%Y-%m-%d %H:%M:%S}' "
                f"- INTERVAL {values[0]} DAY THEN 0 ELSE 1 END")
    return "0"


PARENTS = {"gold_dim_company": "x_dim", "silver_dim_company": "x_companies"}
LAYER_TABLES = {
    "silver_historical_quotes": ("x_quotes", "silver"),
    "silver_income_statement_quarter": ("x_is", "silver"),
    "silver_balance_sheet_quarter": ("x_bs", "silver"),
    "silver_cash_flow_quarter": ("x_cf", "silver"),
    "gold_dim_company": ("x_dim", "gold"), "gold_qmj_z_final": ("x_qmj", "gold"),
}


def _suite_sql() -> str:
    parts = []
    for name, (source, layer) in LAYER_TABLES.items():
        more = "0 AS total_value, " if source == "x_quotes" else ""
        stamped = (f"(SELECT *, {more}'{CTX.run_id}' AS {layer}_invocation_id, TIMESTAMP "
                   f"'{CTX.started_at:%Y-%m-%d %H:%M:%S}' AS {layer}_updated_at FROM {source})")
        checks = checks_of(name, CTX)
        counts = ", ".join(f"{_failures(c)} AS c{i}" for i, c in enumerate(checks))
        rows = ", ".join(f"('{c.name}', c{i}, {c.warn_over}, {c.error_over})"
                         for i, c in enumerate(checks))
        parts.append(f"SELECT '{name}' AS table_name, v.* FROM (SELECT {counts} FROM {stamped} t)"
                     f" n, LATERAL (VALUES {rows}) AS v(test_name, failures, w, e)")
    union = " UNION ALL ".join(parts)
    return (f"SELECT test_name, table_name, CAST(failures AS BIGINT) AS failures, CASE WHEN "
            f"failures > e THEN 'fail' WHEN failures > w THEN 'warn' ELSE 'pass' END AS status "
            f"FROM ({union})")


@query("run_test_suite", _suite_sql())
def run_test_suite(spark, sf_dir):
    """All declared checks of six layer tables, one scan of each."""
    chain = models(spark, sf_dir)
    dim = chain.dim_company()
    found = {"silver_historical_quotes": chain.quotes(), "gold_dim_company": dim,
             "gold_qmj_z_final": chain.qmj()}
    found |= {f"silver_{kind}_quarter": chain.statement(kind) for kind in STATEMENTS}
    parents = {"gold_dim_company": dim, "silver_dim_company": chain.companies()}
    results = []
    for name, (_, layer) in LAYER_TABLES.items():
        df = found[name] if name == "gold_dim_company" else with_audit(found[name], layer, CTX)
        results.append(compiled(df, checks_of(name, CTX), name, parents, CTX.started_at))
    return reduce(DataFrame.unionByName, results)


# Monitoring --------------------------------------------------------------------------------

_STATS = ("training_avg", "training_stddev", "anomaly_score")
SCORES = """SELECT *, CASE WHEN training_stddev IS NULL OR training_set_size = 1 THEN NULL
    WHEN training_stddev = 0 THEN 0 ELSE (metric_value - training_avg) / training_stddev END
    AS anomaly_score FROM x_running WHERE bucket_end >= TIMESTAMP '2024-01-11'"""


def scores(spark, sf_dir):
    rows = metrics(spark, sf_dir).withColumn("updated_at", F.col("bucket_end"))
    return observe.metrics_anomaly_score(rows, AS_OF, days=20)


@query("metrics_anomaly_score", f"""SELECT metric_name, bucket_start, bucket_end,
    metric_value AS latest_metric_value, training_set_size, training_start, training_end,
    {rs(*_STATS)}, coalesce(abs(anomaly_score) > 3, FALSE) AS is_anomaly FROM ({SCORES})""")
def metrics_anomaly_score(spark, sf_dir):
    rows = scores(spark, sf_dir).drop("full_table_name", "column_name", "updated_at")
    return rounded(rows, *_STATS)


@query("anomaly_sensitivity", "SELECT metric_name, metric_value AS latest_metric_value, "
       + rs("anomaly_score") + ", " + ", ".join(
           f"abs(anomaly_score) >= {s} AS is_anomaly_{str(s).replace('.', '_')}"
           for s in (1.5, 2, 2.5, 3, 3.5, 4, 4.5))
       + f" FROM ({SCORES}) WHERE abs(anomaly_score) >= 1.5")
def anomaly_sensitivity(spark, sf_dir):
    rows = observe.anomaly_sensitivity(scores(spark, sf_dir)).drop(
        "full_table_name", "column_name", "metric_avg", "metric_stddev")
    return rounded(rows, "anomaly_score")


@query("monitor_runs", """SELECT metric_name, full_table_name, column_name,
    min(bucket_end) AS first_bucket_end, max(bucket_end) AS last_bucket_end FROM x_metrics
    GROUP BY ALL""")
def monitor_runs(spark, sf_dir):
    return observe.monitor_runs(metrics(spark, sf_dir))


def nodes(spark, sf_dir):
    """One node per event type, with what the first letters of its name suggest."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("unique_id"),
        F.when(F.col("event_type") < "f", "table").otherwise("view").alias("materialization"),
        F.upper("event_type").alias("alias")).distinct()


def described_runs(spark, sf_dir):
    return runs(spark, sf_dir).withColumn(
        "materialization", F.when(F.col("invocation_id") > 10, "incremental"))


NODE = """CASE WHEN user_id > 10 THEN 'incremental' WHEN event_type < 'f' THEN 'table'
    ELSE 'view' END AS materialization, upper(event_type) AS alias"""


@query("model_run_results", f"""SELECT event_id AS model_execution_id, event_type AS unique_id,
    user_id AS invocation_id, ts AS generated_at, {NODE}, row_number() OVER (
    PARTITION BY event_type ORDER BY ts DESC, event_id) AS model_invocation_reverse_index,
    first_value(user_id) OVER w = user_id AS is_the_first_invocation_of_the_day,
    last_value(user_id) OVER w = user_id AS is_the_last_invocation_of_the_day
    FROM events WINDOW w AS (PARTITION BY CAST(ts AS DATE) ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def model_run_results(spark, sf_dir):
    return observe.model_run_results(described_runs(spark, sf_dir), nodes(spark, sf_dir))


@query("snapshot_seed_run_results", f"""SELECT event_id AS model_execution_id,
    event_type AS unique_id, user_id AS invocation_id, ts AS generated_at, {NODE} FROM events
    WHERE event_type IN ('click', 'view')""")
def snapshot_seed_run_results(spark, sf_dir):
    wanted = nodes(spark, sf_dir).where("unique_id IN ('click', 'view')")
    return observe.snapshot_seed_run_results(described_runs(spark, sf_dir), wanted)


JOB_ID = "CASE WHEN event_id % 20 <> 0 THEN concat('job ', event_id % 7) END"


@query("job_run_results", f"""SELECT event_type AS name, id, run_id,
    min(ts) AS run_started_at, max(ts) + INTERVAL 90 SECOND AS run_completed_at,
    CAST(date_sub('second', min(ts), max(ts) + INTERVAL 90 SECOND) AS BIGINT)
    AS run_execution_time FROM (SELECT *, CAST(user_id AS VARCHAR) AS run_id, {JOB_ID} AS id
    FROM events) WHERE id IS NOT NULL GROUP BY ALL""")
def job_run_results(spark, sf_dir):
    """One event in twenty belongs to no job and falls out by the rule."""
    invocations = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job_name"), F.expr(JOB_ID).alias("job_id"),
        F.col("user_id").cast("string").alias("job_run_id"), F.col("ts").alias("run_started_at"),
        (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("run_completed_at"))
    return observe.job_run_results(invocations)


RESULT = """CASE WHEN value < 50 THEN 'pass' WHEN value < 100 THEN 'warn'
    WHEN value < 150 THEN 'skipped' ELSE 'fail' END"""


@query("alerts_union", f"""SELECT * FROM (
    SELECT event_id AS alert_id, CASE event_type WHEN 'click' THEN 'dbt_test' WHEN 'view' THEN
    'anomaly_detection' WHEN 'signup' THEN 'schema_change' WHEN 'purchase' THEN 'model'
    ELSE 'source_freshness' END AS alert_type, {RESULT} AS status, ts AS detected_at FROM events)
    WHERE status <> 'pass' AND (status <> 'skipped' OR alert_type = 'source_freshness')""")
def alerts_union(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("status", F.expr(RESULT))
    kinds = F.create_map(*[F.lit(x) for x in (
        "click", "dbt_test", "view", "anomaly_detection", "signup", "schema_change")])
    tests = events.select(F.col("event_id").alias("id"), kinds[F.col("event_type")]
                          .alias("test_type"), "status", F.col("ts").alias("detected_at"))
    models_ = events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("model_execution_id"),
        F.when(F.col("status") == "pass", "success").otherwise(F.col("status")).alias("status"),
        F.col("ts").alias("generated_at"))
    fresh = events.where("event_type = 'error'").select(
        F.col("event_id").alias("source_freshness_execution_id"), "status",
        F.col("ts").alias("generated_at"))
    return observe.alerts_union(tests, models_, fresh)


@query("schema_snapshot", """SELECT 'customer' AS full_table_name, column_name, is_new, n_values
    FROM (SELECT unnest([
    {'column_name': 'c_custkey', 'is_new': FALSE, 'n_values': count(c_custkey)},
    {'column_name': 'c_name', 'is_new': FALSE, 'n_values': count(c_name)},
    {'column_name': 'c_nationkey', 'is_new': FALSE, 'n_values': count(c_nationkey)},
    {'column_name': 'c_acctbal', 'is_new': FALSE, 'n_values': count(c_acctbal)},
    {'column_name': 'c_mktsegment', 'is_new': TRUE, 'n_values': count(c_mktsegment)}],
    recursive := TRUE) FROM customer)""")
def schema_snapshot(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    before = observe.schema_snapshot(customers.drop("c_mktsegment"), "customer", None, AS_OF)
    now = observe.schema_snapshot(customers, "customer", before, AS_OF)
    counts = customers.agg(*[F.count(c).alias(c) for c in customers.columns]).unpivot(
        [], customers.columns, "column_name", "n_values")
    return now.join(counts, "column_name").select(
        "full_table_name", "column_name", "is_new", "n_values")
