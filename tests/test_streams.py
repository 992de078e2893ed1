"""Streams drained in one go and across a restart."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from factorloom.sources.store import Warehouse
from factorloom.streaming import audit, claims, event_windows


def messages(spark, first, last):
    return spark.range(first, last).selectExpr(
        "'T' || id AS ticker", "'b' AS batch_id", "'q' AS data_type", "'s' AS source",
        "'2024-01-01' AS created_at_ts", "'u' || id AS url")


def test_restart_continues_from_checkpoint(spark, tmp_path):
    topic, land, errors, mark = (str(tmp_path / n) for n in ("t", "l", "e", "c"))

    def fetch(batch):
        return batch.withColumn("ok", F.substring("url", 2, 9).cast("int") % 2 == 0)

    for first in (0, 10):
        claims.publish(messages(spark, first, first + 10), topic)
        claims.load_pass(claims.claim_checks(spark, topic), fetch, land, errors,
                         mark).awaitTermination()
    assert spark.read.parquet(land).select("url").distinct().count() == 10
    assert spark.read.parquet(land).count() == 10
    assert claims.parse_messages(spark.read.text(f"{errors}/*")).count() == 10


def test_failed_messages_carry_attempt_and_reason(spark, tmp_path):
    topic, land, mark = (str(tmp_path / n) for n in ("t", "l", "c"))

    def fetch(batch):
        number = F.substring("url", 2, 9).cast("int")
        return batch.withColumn("ok", number % 3 == 0).withColumn(
            "reason", F.when(number % 3 == 1, "not found"))

    claims.publish(messages(spark, 0, 6), topic)
    folders = claims.load_with_retry(spark, topic, land, mark, fetch)
    for folder, attempt in (("retry", 1), ("dlq", 2)):
        got = spark.read.json(f"{folders[folder]}/*").select("url", "attempt", "reason").collect()
        assert sorted((r.url, r.attempt, r.reason) for r in got) == [
            (u, attempt, w) for u, w in (("u1", "not found"), ("u2", "fetch failed"),
                                         ("u4", "not found"), ("u5", "fetch failed"))]


def test_bad_messages_are_skipped(spark):
    lines = spark.createDataFrame([('{"ticker": "A"}',), ("{oops",), (None,), ("",)],
                                  "value string")
    got = claims.parse_messages(lines).where("ticker IS NOT NULL")
    assert [r.ticker for r in got.collect()] == ["A"]


def test_unknown_outcome_is_a_failure(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, ok boolean")
    good, bad = claims.split_failures(df)
    assert good.count() == 1 and bad.count() == 2


def test_audit_defaults(spark):
    df = spark.createDataFrame(
        [('{"metadata": {"query": "select /* a\\n b */ 1\\n  from t "}, "statistics":'
          ' {"cpuTime": "x", "wallTime": 2.5}}',), ('{"metadata": {"queryId": "q"}}',)], "v string")
    events = df.select(F.from_json("v", audit.EVENT_SCHEMA).alias("e")).select("e.*")
    got = audit.normalise_query_events(events).collect()
    assert len(got) == 1
    assert got[0].query_text == "select 1 from t" and got[0].query_id == "unknown_id"
    assert got[0].cpu_time_s == 0.0 and got[0].wall_time_s == 2.5
    assert got[0].created_at.year == 1970


# Publishing ---------------------------------------------------------------------------------

def test_busy_key_is_written_by_several_tasks_and_read_in_order(spark, tmp_path):
    topic = str(tmp_path / "t")
    rows = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'k' || id % 100 END AS ticker", "'b' AS batch_id",
        "'q' AS data_type", "'s' AS source", "'2024-01-01' AS created_at_ts",
        "lpad(CAST(id * 7919 % 9000 AS string), 6, '0') AS url")
    # small as they are, the tasks would be merged
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        claims.publish(rows, topic, part_rows=250)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sent = spark.read.text(topic).select("value", F.input_file_name().alias("file"))
    got = claims.parse_messages(sent.select("value"))
    assert got.count() == 9000
    hot = sent.where("value LIKE '%\"hot\"%'").groupBy("file").count().collect()
    assert len(hot) > 2 and max(r["count"] for r in hot) < 3000
    by_key = {}
    for r in got.orderBy("ticker", "seq").collect():
        by_key.setdefault(r.ticker, []).append((r.seq, r.url))
    for own in by_key.values():
        assert [n for n, _ in own] == list(range(len(own)))
        assert [u for _, u in own] == sorted(u for _, u in own)


def test_numbers_of_ties_and_null_keys(spark):
    rows = spark.createDataFrame([(None, "a")] * 3 + [("x", "b")] * 2 + [("x", None)],
                                 "ticker string, url string")
    got = claims.numbered(rows, "ticker", ["url"]).collect()
    assert sorted(r.seq for r in got if r.ticker is None) == [0, 1, 2]
    assert sorted((r.seq, r.url) for r in got if r.ticker)[0] == (0, None)


def test_republished_messages_are_loaded_once_across_a_restart(spark, tmp_path):
    topic, land, errors, mark = (str(tmp_path / n) for n in ("t", "l", "e", "c"))

    def load():
        stream = claims.distinct_messages(claims.claim_checks(spark, topic, files_per_trigger=1))
        claims.load_pass(stream, lambda b: b.withColumn("ok", F.lit(True)), land, errors,
                         mark).awaitTermination()

    claims.publish(messages(spark, 0, 20), topic)
    load()
    claims.publish(messages(spark, 10, 30), topic)
    claims.publish(messages(spark, 0, 30), topic)
    load()
    got = [r.url for r in spark.read.parquet(land).collect()]
    assert len(got) == 30 and len(set(got)) == 30


# Event-time windows -------------------------------------------------------------------------

SCHEMA = "user string, ts timestamp, value double"


def feed(spark, folder, *rows):
    """One more file of events (user, minute, value)."""
    made = [(u, m, v) for u, m, v in rows]
    spark.createDataFrame(made, "user string, m int, value double").selectExpr(
        "user", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, m) AS ts",
        "value").coalesce(1).write.mode("append").parquet(folder)


def finished(spark, tmp_path, count):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    event_windows.append_windows(count(stream), out, mark).awaitTermination()
    start = F.expr("CAST((unix_timestamp(window_start) - unix_timestamp("
                   "timestamp'2024-01-01 00:00:00')) / 60 AS int)")
    end = F.expr("CAST((unix_timestamp(window_end) - unix_timestamp("
                 "timestamp'2024-01-01 00:00:00')) / 60 AS int)")
    rows = spark.read.parquet(out).withColumns({"window_start": start, "window_end": end})
    return sorted(tuple(r) for r in rows.collect())


def test_late_rows_count_until_the_watermark_passes(spark, tmp_path):
    source = str(tmp_path / "in")

    def count(stream):
        return event_windows.tumbling_counts(stream, "ts", "60 minutes", lateness="30 minutes",
                                             total="value")

    feed(spark, source, ("a", 5, 1.0), ("a", 80, 2.0))
    assert finished(spark, tmp_path, count) == []
    # minute 20 is late, but the watermark stands at 50; the restart keeps the open windows
    feed(spark, source, ("b", 20, 4.0), ("b", 95, 8.0))
    assert finished(spark, tmp_path, count) == [(0, 60, 2, 5.0)]
    # minute 30 comes after its window was given out
    feed(spark, source, ("c", 30, 16.0), ("c", 170, 32.0))
    assert finished(spark, tmp_path, count) == [(0, 60, 2, 5.0), (60, 120, 2, 10.0)]


def test_sliding_windows_hold_an_event_each(spark, tmp_path):
    feed(spark, str(tmp_path / "in"), ("a", 25, 1.0), ("a", 35, 1.0), ("a", 500, 1.0))
    got = finished(spark, tmp_path, lambda s: event_windows.sliding_counts(
        s, "ts", "60 minutes", "30 minutes", lateness="0 minutes"))
    assert got == [(-30, 30, 1), (0, 60, 2), (30, 90, 1)]


def test_late_event_joins_two_sessions(spark, tmp_path):
    source = str(tmp_path / "in")

    def count(stream):
        return event_windows.session_counts(stream, "ts", "10 minutes", ["user"],
                                            lateness="60 minutes")

    feed(spark, source, ("a", 0, 1.0), ("a", 16, 1.0), ("b", 3, 1.0))
    assert finished(spark, tmp_path, count) == []
    feed(spark, source, ("a", 8, 1.0), ("c", 200, 1.0))
    assert finished(spark, tmp_path, count) == [(0, 26, "a", 3), (3, 13, "b", 1)]


# Compaction ---------------------------------------------------------------------------------

def test_compaction_takes_news_in_and_may_be_repeated(spark, tmp_path):
    source, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    store = Warehouse(spark, str(tmp_path / "tables"))
    as_of = datetime(2024, 1, 2, tzinfo=timezone.utc)

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        claims.compact_stream(stream, "user", "ts", store, mark, as_of).awaitTermination()

    def newest(df):
        return sorted((r.user, r.value) for r in df.collect())

    feed(spark, source, ("a", 5, 1.0), ("a", 80, 2.0), ("b", 1, 3.0))
    run()
    assert newest(claims.fold_log(store, "user", "ts", as_of)) == [("a", 2.0), ("b", 3.0)]
    feed(spark, source, ("a", 60, 9.0), ("b", 90, 4.0), ("c", 0, 5.0))
    run()
    store.refresh(claims.LOG_NEWS)
    assert newest(claims.compacted_log(store, "user", "ts", as_of)) == [
        ("a", 2.0), ("b", 4.0), ("c", 5.0)]
    for _ in range(2):
        assert newest(claims.fold_log(store, "user", "ts", as_of)) == [
            ("a", 2.0), ("b", 4.0), ("c", 5.0)]
    assert store.read(claims.LOG_NEWS).count() == 0


def test_audit_source_is_written_by_as_many_tasks_as_the_session_shuffles_to(
        spark, tmp_path, monkeypatch):
    from suite import q_streams

    spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id bigint, text string"
                          ).write.parquet(str(tmp_path / "documents.parquet"))
    spark.sql("SELECT id AS event_id, id % 7 AS user_id, 'view' AS event_type, 1.5D AS value,"
              " TIMESTAMP_NTZ'2024-01-01 10:00:00' AS ts FROM range(600)"
              ).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(q_streams, "scratch_path", lambda _, name: str(tmp_path / f"x-{name}"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        rows = q_streams.stream_audit_sink(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [(r["n_rows"], r["bytes"]) for r in rows] == [(600, sum(range(600)))]
    assert len(list((tmp_path / "x-events").glob("*.parquet"))) == 9
