"""The ingest run: from the state of each key to landed rows, once.

A run works on one feed.  The reference keys and the watermarks say what to ask for; the requests
are published under the run's number and drained in two passes; what arrived is flattened and
appended under the run's number; then the keys are recorded and the watermarks take the newest
ingest time.  Every step finds what an earlier try of the same run has done and does not repeat
it in the result: a published batch is left as it is, a drained position is kept in the
checkpoint, a micro-batch and a load replace their first try.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.catalogue import TABLES, TableSpec
from factorloom.context import RunContext
from factorloom.operators import reshape, state
from factorloom.sources.store import Warehouse
from factorloom.streaming import claims

STATE = TableSpec("ingest_state", "batch_id string, data_type string, ticker string,"
                  " created_time timestamp", (), ())
WATERMARK = TableSpec("ingest_watermark", "ticker string, data_type string,"
                      " ticker_status string, updated_at timestamp", (), ())
RUNS = TableSpec("ingest_runs", "batch_id string, data_type string, planned bigint,"
                 " landed bigint, retried bigint, dead bigint", (), ())

Fetch = Callable[[DataFrame], DataFrame]


def _documents(rows: DataFrame, ctx: RunContext) -> DataFrame:
    return reshape.stamp_ingest_time(reshape.payload_to_json(rows), ctx)


def _reports(rows: DataFrame, ctx: RunContext) -> DataFrame:
    return reshape.stamp_ingest_time(reshape.flatten_reports(rows), ctx)


@dataclass(frozen=True)
class Feed:
    """What a run lands: the request kind, the table, and how a payload becomes its rows."""

    data_type: str
    kind: str
    table: str
    flatten: Callable[[DataFrame, RunContext], DataFrame]
    report: str | None = None

    @property
    def spec(self) -> TableSpec:
        return TABLES[self.table]


# The feeds with their request kinds, tables and reports.
FEEDS = {feed.data_type: feed for feed in (
    Feed("historical_quotes", "historical_quotes", "historical_quotes", reshape.flatten_quotes),
    Feed("fundamental_1", "fundamental_1", "fundamental_1", _documents),
    Feed("fundamental_2", "fundamental_2", "fundamental_2", _documents),
    Feed("fundamental_quarter", "fundamental_quarter", "fundamental_quarter",
         reshape.flatten_fundamental_quarter),
    Feed("dividend_year", "dividend", "dividend_year", reshape.flatten_dividends),
    *(Feed(f"{report}_quarter", "quarter_report", "financial_reports_quarter", _reports, report)
      for report in ("income_statement", "balance_sheet", "cash_flow_indirect")),
)}


def _held(store: Warehouse, spec: TableSpec) -> DataFrame:
    held = store.read_or_none(spec.name)
    return store.spark.createDataFrame([], spec.schema) if held is None else held


def planned(store: Warehouse, feed: Feed, reference: DataFrame, ctx: RunContext,
            changed: DataFrame | None = None, base_url: str | None = None) -> DataFrame:
    """The requests of a run: active keys that no other run has asked for of late.

    Expires the state, brings the watermarks in line with the reference and resets those of
    ``changed`` keys, unless an earlier try of this run has.
    """
    kept = state.expire_state(_held(store, STATE), feed.data_type, ctx.started_at)
    store.replace(kept, STATE)
    store.replace(state.sync_watermark(_held(store, WATERMARK), reference, feed.data_type,
                                       ctx.fallback_date, changed), WATERMARK)
    asked = store.read(STATE.name).where(
        (F.col("data_type") == feed.data_type) & (F.col("batch_id") != ctx.run_id))
    starts = state.start_dates(store.read(WATERMARK.name), feed.data_type).join(
        asked.select("ticker").distinct(), "ticker", "left_anti")
    more = {} if base_url is None else {"base_url": base_url}
    return state.plan_tasks(starts, feed.kind, feed.data_type, ctx, report=feed.report, **more)


def land(store: Warehouse, feed: Feed, reference: DataFrame, fetch: Fetch, ctx: RunContext,
         folder: str, retry_fetch: Fetch | None = None, changed: DataFrame | None = None,
         base_url: str | None = None) -> DataFrame:
    """Run one feed; returns its row of ``ingest_runs``.

    ``fetch`` adds the nested payload ``data``, a boolean ``ok`` and perhaps a ``reason`` to a
    batch of messages; ``folder`` keeps topics, landing files and positions.  What fails in both
    passes stays in the dead-letter topic, its keys unrecorded, so the next run asks again.
    """
    done = _held(store, RUNS).where(
        (F.col("batch_id") == ctx.run_id) & (F.col("data_type") == feed.data_type))
    if not done.isEmpty():
        return done
    spark, place = store.spark, f"{folder.rstrip('/')}/{feed.data_type}"
    topic, landing = f"{place}/topic", f"{place}/landing/{ctx.run_id}"
    if not claims.published(spark, topic, ctx.run_id):
        tasks = planned(store, feed, reference, ctx, changed, base_url)
        claims.publish_once(tasks.drop("fetch_limit"), topic, ctx.run_id)
    batch = f"{topic}/batch={ctx.run_id}"
    folders = claims.load_with_retry(
        spark, batch, landing, f"{place}/position/{ctx.run_id}", fetch, retry_fetch,
        once=claims.MESSAGE_KEY)

    sent = claims.parse_messages(spark.read.text(batch))
    landed = claims.landed(spark, landing)
    dead = claims.messages_in(spark, folders["dlq"])
    if landed is not None:
        rows = feed.flatten(landed, ctx).withColumn(
            "message_processed_time", F.lit(ctx.started_at))
        rows = rows.select(*[c for c in feed.spec.schema.names if c in rows.columns])
        store.append(rows, feed.spec, batch=f"{feed.data_type}-{ctx.run_id}")
        keys = landed.select("ticker").distinct()
        others = _held(store, STATE).where(~((F.col("batch_id") == ctx.run_id)
                                             & (F.col("data_type") == feed.data_type)))
        store.replace(state.record_state(others, keys, feed.data_type, ctx.run_id, ctx), STATE)
    if "year" in feed.spec.schema.names:
        store.replace(state.reconcile_watermark(
            _held(store, WATERMARK), store.read_or_none(feed.table), feed.data_type, ctx.today),
            WATERMARK)

    def count(df: DataFrame | None) -> int:
        return 0 if df is None else df.count()

    n_landed, again = count(landed), count(
        None if landed is None else landed.where(F.col("pass") == "retry"))
    summary = spark.createDataFrame(
        [(ctx.run_id, feed.data_type, count(sent), n_landed, again, count(dead))], RUNS.schema)
    store.append(summary, RUNS)
    return summary
