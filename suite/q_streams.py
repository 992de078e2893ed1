"""Message streams over the events table, drained and read back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from factorloom.plans import landing
from factorloom.session import scratch_path
from factorloom.sources.store import Warehouse
from factorloom.streaming import audit, claims, event_windows
from suite.inputs import CTX, table
from suite.registry import query

STREAM_FILES = 2
# Events of one task, and file, where they get their texts.
TASK_EVENTS = 5_000


def claim_messages(spark, sf_dir):
    """One request message per event."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("ticker"), F.lit("b1").alias("batch_id"),
        F.col("event_type").alias("data_type"), F.lit("suite").alias("source"),
        F.col("ts").cast("string").alias("created_at_ts"),
        F.concat(F.lit("suite://"), F.col("event_id").cast("string")).alias("url"))


def per_type(df):
    return df.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ticker").alias("n_tickers"))


PER_TYPE = """SELECT event_type AS data_type, count(*) AS n_rows,
    count(DISTINCT user_id) AS n_tickers FROM events GROUP BY event_type"""


@query("stream_keyed_publish", PER_TYPE)
def stream_keyed_publish(spark, sf_dir):
    topic = scratch_path(spark, "topic")
    claims.publish(claim_messages(spark, sf_dir), topic)
    return per_type(claims.parse_messages(spark.read.text(topic)))


@query("stream_claim_checks", PER_TYPE)
def stream_claim_checks(spark, sf_dir):
    """Every message once; one unreadable line per error event is skipped."""
    topic, out, mark = (scratch_path(spark, n) for n in ("topic", "out", "checkpoint"))
    claims.publish(claim_messages(spark, sf_dir), topic)
    broken = table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.concat(F.lit("{broken "), F.col("event_id").cast("string")).alias("value"))
    broken.write.mode("append").text(topic)
    stream = claims.claim_checks(spark, topic, files_per_trigger=STREAM_FILES)
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return per_type(spark.read.parquet(out))


def responder(spark, sf_dir, ok: str):
    """Stands in for the remote source: each message's answer and whether it arrived."""
    answers = table(spark, sf_dir, "events").selectExpr(
        "'suite://' || event_id AS url", "value AS payload", f"({ok}) AS ok")

    def fetch(batch):
        return batch.join(answers, "url", "left")

    return fetch


@query("stream_micro_batch_load", """SELECT event_type AS data_type, count(*) AS n_rows,
    round(sum(CAST(value AS DECIMAL(18,2))), 2)::DOUBLE AS total FROM events GROUP BY 1""")
def stream_micro_batch_load(spark, sf_dir):
    topic, land, errors, mark = (
        scratch_path(spark, n) for n in ("topic", "landing", "errors", "checkpoint"))
    claims.publish(claim_messages(spark, sf_dir), topic)
    stream = claims.claim_checks(spark, topic, files_per_trigger=STREAM_FILES)
    claims.load_pass(stream, responder(spark, sf_dir, "TRUE"), land, errors,
                     mark).awaitTermination()
    return spark.read.parquet(land).groupBy("data_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("payload").cast("decimal(18,2)")).cast("double").alias("total"))


@query("stream_retry_dlq", """SELECT route, event_type AS data_type, count(*) AS n_rows FROM (
    SELECT *, CASE WHEN event_type <> 'error' THEN 'first' WHEN value >= 20 THEN 'retry'
    ELSE 'dlq' END AS route FROM events) GROUP BY ALL""")
def stream_retry_dlq(spark, sf_dir):
    """Error events fail at first; those of 20 and more succeed on retry, the rest never."""
    topic, land, mark = (scratch_path(spark, n) for n in ("topic", "landing", "checkpoint"))
    claims.publish(claim_messages(spark, sf_dir), topic)
    folders = claims.load_with_retry(
        spark, topic, land, mark, responder(spark, sf_dir, "event_type <> 'error'"),
        responder(spark, sf_dir, "event_type <> 'error' OR value >= 20"))
    landed = spark.read.parquet(land).select(F.col("pass").alias("route"), "data_type")
    dead = claims.parse_messages(spark.read.text(f"{folders['dlq']}/*")).select(
        F.lit("dlq").alias("route"), "data_type")
    return landed.unionByName(dead).groupBy("route", "data_type").agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("stream_compact_latest", """SELECT user_id, ts, event_id FROM events
    WHERE ts >= TIMESTAMP '2024-01-20'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_compact_latest(spark, sf_dir):
    source, folder, mark = (scratch_path(spark, n) for n in ("log", "compact", "checkpoint"))
    store = Warehouse(spark, folder)
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    rows.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option(
        "maxFilesPerTrigger", STREAM_FILES).parquet(source)
    as_of = datetime(2024, 1, 30, tzinfo=timezone.utc)
    claims.compact_stream(stream, "user_id", "ts", store, mark, as_of,
                          hours=240).awaitTermination()
    return claims.fold_log(store, "user_id", "ts", as_of, hours=240)


def query_events(spark, sf_dir):
    """Query events: the event's numbers with a document as query text, in turn.

    Sign-ups carry no statistics; errors carry neither a user nor a readable number.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    turn = F.col("event_id") % docs.agg(F.count(F.lit(1))).scalar()
    events = table(spark, sf_dir, "events").withColumn("doc_id", turn)
    # An event is small and gets a long text: events are dealt before that, to a fixed number of
    # tasks, which are not merged.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                -(-events.count() // TASK_EVENTS))
    rows = events.repartition(parts, "doc_id").join(docs, "doc_id", "left")
    failed = "event_type = 'error'"
    return rows.selectExpr(
        "struct(CAST(event_id AS STRING) AS queryId, '/* job */ ' || text AS query,"
        " event_type AS queryState) AS metadata",
        f"struct(CASE WHEN {failed} THEN NULL ELSE CAST(user_id AS STRING) END AS user,"
        " 'suite' AS source, 'main' AS catalog, CAST(NULL AS STRING) AS schema) AS context",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") AS createTime",
        f"CASE WHEN event_type <> 'signup' THEN struct(CASE WHEN {failed} THEN 'broken'"
        " ELSE CAST(value AS STRING) END AS cpuTime, CAST(NULL AS STRING) AS failedCpuTime,"
        " CAST(value * 2 AS STRING) AS wallTime, CAST(event_id AS STRING) AS physicalInputBytes,"
        " CAST(NULL AS STRING) AS peakUserMemoryBytes) END AS statistics")


@query("stream_audit_normalise", r"""SELECT CAST(event_id AS VARCHAR) AS query_id,
    CASE WHEN event_type = 'error' THEN 'unknown_user' ELSE CAST(user_id AS VARCHAR) END
    AS user_name, 'suite' AS source_app, 'main' AS catalog_name,
    'unknown_schema' AS schema_name, event_type AS query_state, ts AS created_at,
    trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS query_text,
    CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS cpu_time_s,
    CAST(0 AS DOUBLE) AS failed_cpu_time_s, value * 2 AS wall_time_s, event_id AS scanned_bytes,
    CAST(0 AS BIGINT) AS peak_memory_bytes
    FROM events LEFT JOIN documents
    ON event_id % (SELECT count(*) FROM documents) = doc_id WHERE event_type <> 'signup'""")
def stream_audit_normalise(spark, sf_dir):
    rows = audit.normalise_query_events(query_events(spark, sf_dir))
    return rows.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("stream_audit_sink", """SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows,
    sum(event_id)::BIGINT AS bytes FROM events WHERE event_type <> 'signup' GROUP BY 1""")
def stream_audit_sink(spark, sf_dir):
    source, folder, mark = (scratch_path(spark, n) for n in ("events", "audit", "checkpoint"))
    events = query_events(spark, sf_dir)
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    audit.audit_sink(stream, folder, mark, seconds=None).awaitTermination()
    return spark.read.parquet(folder).groupBy("day").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("scanned_bytes").alias("bytes"))


# Event-time windows: those given out until the watermark, two hours behind the newest event.

LATE = "2 hours"
DONE = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR FROM events)"
CENTS = "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total"


def windows(spark, sf_dir, count):
    """Finished windows over the events as a stream, read back from the sink."""
    source, folder, mark = (scratch_path(spark, n) for n in ("events", "windows", "checkpoint"))
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    rows.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(source)
    stream = spark.readStream.schema(
        "user_id bigint, event_type string, ts timestamp, value double").parquet(source)
    event_windows.append_windows(count(stream), folder, mark).awaitTermination()
    found = spark.read.parquet(folder)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz")
                              for c in ("window_start", "window_end")})


@query("event_tumbling_counts", f"""SELECT window_start, window_start + INTERVAL 1 HOUR
    AS window_end, event_type, count(*) AS n_events, {CENTS}
    FROM (SELECT *, date_trunc('hour', ts) AS window_start FROM events)
    WHERE window_start + INTERVAL 1 HOUR <= {DONE} GROUP BY ALL""")
def event_tumbling_counts(spark, sf_dir):
    return windows(spark, sf_dir, lambda s: event_windows.tumbling_counts(
        s, "ts", "1 hour", ["event_type"], LATE, "value"))


@query("event_sliding_counts", f"""SELECT window_start, window_start + INTERVAL 6 HOUR
    AS window_end, count(*) AS n_events, {CENTS}
    FROM (SELECT *, time_bucket(INTERVAL 2 HOUR, ts) - k * INTERVAL 2 HOUR AS window_start
          FROM events, (VALUES (0), (1), (2)) AS steps(k))
    WHERE window_start + INTERVAL 6 HOUR <= {DONE} GROUP BY window_start""")
def event_sliding_counts(spark, sf_dir):
    return windows(spark, sf_dir, lambda s: event_windows.sliding_counts(
        s, "ts", "6 hours", "2 hours", lateness=LATE, total="value"))


@query("event_session_counts", f"""SELECT min(ts) AS window_start,
    max(ts) + INTERVAL 6 HOUR AS window_end, user_id, count(*) AS n_events, {CENTS}
    FROM (SELECT *, sum(CASE WHEN ts - before <= INTERVAL 6 HOUR THEN 0 ELSE 1 END)
          OVER (PARTITION BY user_id ORDER BY ts) AS session
          FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events))
    GROUP BY user_id, session HAVING max(ts) + INTERVAL 6 HOUR <= {DONE}""")
def event_session_counts(spark, sf_dir):
    return windows(spark, sf_dir, lambda s: event_windows.session_counts(
        s, "ts", "6 hours", ["user_id"], LATE, "value"))


@query("stream_dedup_messages", """SELECT event_type AS data_type, count(*) AS n_rows,
    round(sum(CAST(value AS DECIMAL(18,2))), 2)::DOUBLE AS total FROM events GROUP BY 1""")
def stream_dedup_messages(spark, sf_dir):
    """All requests are published twice and loaded once, across micro-batches."""
    topic, land, mark = (scratch_path(spark, n) for n in ("topic", "landing", "checkpoint"))
    sent = claim_messages(spark, sf_dir).withColumn("batch_id", F.col("url"))
    for _ in range(2):
        claims.publish(sent, topic)
    claims.load_with_retry(spark, topic, land, mark, responder(spark, sf_dir, "TRUE"),
                           files_per_trigger=STREAM_FILES, once=claims.MESSAGE_KEY,
                           within="60 days")
    return spark.read.parquet(land).groupBy("data_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("payload").cast("decimal(18,2)")).cast("double").alias("total"))


@query("ingest_run", """SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(sum(CAST(l_quantity AS DECIMAL(18,2)))
    AS DOUBLE) AS amount FROM lineitem WHERE l_suppkey % 10 <> 0 GROUP BY 1, 2""")
def ingest_run(spark, sf_dir):
    """Suppliers ask for yearly amounts; every fifth fails at first, every tenth for good."""
    store, folder = Warehouse(spark, scratch_path(spark, "tables")), scratch_path(spark, "feeds")
    yearly = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.year("l_shipdate").alias("year")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("amount"))
    payload = yearly.groupBy("ticker").agg(F.collect_list(F.struct("year", "amount"))
                                           .alias("data"))
    keys = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ticker"))

    def fetch(every: int):
        def answer(batch):
            return batch.join(payload, "ticker", "left").withColumn(
                "ok", F.col("ticker").cast("bigint") % every != 0)
        return answer

    landing.land(store, landing.FEEDS["dividend_year"], keys, fetch(5), CTX, folder, fetch(10))
    amount = F.get_json_object("data", "$.amount").cast("double").alias("amount")
    return store.read("dividend_year").where("year IS NOT NULL").select("ticker", "year", amount)
