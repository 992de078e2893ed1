"""Query events of the SQL engine to an audit table partitioned by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factorloom.functions.exprs import one_line_query

EVENT_SCHEMA = (
    "metadata struct<queryId: string, query: string, queryState: string>,"
    " context struct<user: string, source: string, catalog: string, schema: string>,"
    " createTime string,"
    " statistics struct<cpuTime: string, failedCpuTime: string, wallTime: string,"
    " physicalInputBytes: string, peakUserMemoryBytes: string>"
)

# Output columns with their source and the value used when it is missing.
TEXT_DEFAULTS = {
    "query_id": ("metadata.queryId", "unknown_id"),
    "user_name": ("context.user", "unknown_user"),
    "source_app": ("context.source", "unknown_app"),
    "catalog_name": ("context.catalog", "unknown_catalog"),
    "schema_name": ("context.schema", "unknown_schema"),
    "query_state": ("metadata.queryState", "UNKNOWN"),
}
NUMBERS = {
    "cpu_time_s": ("statistics.cpuTime", "double"),
    "failed_cpu_time_s": ("statistics.failedCpuTime", "double"),
    "wall_time_s": ("statistics.wallTime", "double"),
    "scanned_bytes": ("statistics.physicalInputBytes", "bigint"),
    "peak_memory_bytes": ("statistics.peakUserMemoryBytes", "bigint"),
}
NO_TIME = "1970-01-01T00:00:00Z"
BATCH_SECONDS = 5


def _number(source: str, kind: str) -> Column:
    return F.coalesce(F.col(source).try_cast(kind), F.lit(0).cast(kind))


def normalise_query_events(events: DataFrame) -> DataFrame:
    """Flat audit rows; events without statistics are dropped, gaps get defaults."""
    texts = [F.coalesce(F.col(s), F.lit(d)).alias(o) for o, (s, d) in TEXT_DEFAULTS.items()]
    created = F.coalesce(F.try_to_timestamp(F.col("createTime")),
                         F.to_timestamp(F.lit(NO_TIME)))
    numbers = [_number(s, t).alias(o) for o, (s, t) in NUMBERS.items()]
    return events.where(F.col("statistics").isNotNull()).select(
        *texts, created.alias("created_at"),
        one_line_query("metadata.query").alias("query_text"), *numbers)


def audit_sink(events: DataFrame, folder: str, checkpoint: str,
               seconds: int | None = BATCH_SECONDS) -> StreamingQuery:
    """Append audit rows to day folders; ``seconds=None`` drains what is there and stops.

    Spark's file sink records finished batches in its own log, so a restarted stream does not
    write a batch twice.
    """
    rows = normalise_query_events(events).withColumn("day", F.to_date("created_at"))
    trigger = {"availableNow": True} if seconds is None else {
        "processingTime": f"{seconds} seconds"}
    return (
        rows.writeStream.format("parquet").partitionBy("day")
        .option("path", folder).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )
