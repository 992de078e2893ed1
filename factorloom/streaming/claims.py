"""Request messages (claim checks) and the landing of what they point to.

A topic is a folder of JSON-lines files here; with the Kafka connector on the class path the
same frames go through ``format("kafka")``.  Runs drain a topic with ``availableNow`` and keep
their position in a checkpoint, which replaces committed offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factorloom.catalogue import TableSpec
from factorloom.session import cut_lineage, small_side
from factorloom.sources.store import LOAD, Warehouse

# Message fields, files per micro-batch, topic retention.
MESSAGE_SCHEMA = ("ticker string, batch_id string, data_type string, source string,"
                  " created_at_ts string, url string, seq bigint")
MESSAGE_KEY = ("ticker", "batch_id", "data_type")
FILES_PER_TRIGGER = 10
RETENTION_HOURS = 24
# What a failed message says where the fetch gave no reason.
FETCH_FAILED = "fetch failed"
# Messages of one key in one file.
PART_ROWS = 100_000
# Tables of the compacted copy and of what came since.
LOG, LOG_NEWS = "log", "log_news"


def numbered(tasks: DataFrame, key: str, order: Sequence[str], column: str = "seq") -> DataFrame:
    """``tasks`` with a running number per key, in order, from 0.

    Rows are range-partitioned by key and order, so a busy key lies over several tasks; each
    counts its own rows of the key, and the counts before are added.
    """
    rows = cut_lineage(
        tasks.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()),
        "ranged")
    sizes = rows.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = small_side(sizes.select(F.col(key).alias("_key"), F.col("_part").alias("_of"),
                                      F.coalesce(F.sum("_n").over(before), F.lit(0))
                                      .alias("_offset")).where("_offset > 0"))
    own = Window.partitionBy("_part", key).orderBy(*order)
    return rows.withColumn("_at", F.row_number().over(own) - 1).join(
        offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of")), "left"
    ).select(*tasks.columns, (F.col("_at") + F.coalesce("_offset", F.lit(0))).cast("bigint")
             .alias(column))


def publish(tasks: DataFrame, topic: str, key: str = "ticker",
            order: Sequence[str] = ("created_at_ts", "url"), part_rows: int = PART_ROWS) -> None:
    """Append messages to a topic, each with its number among those of its key.

    Files are dealt by key and, within a key, by ``part_rows`` numbers, so a key with a large
    share of the messages is written by several tasks; its order is that of the numbers.
    """
    write_messages(tasks, topic, key, order, part_rows, "append")


def write_messages(tasks: DataFrame, folder: str, key: str, order: Sequence[str],
                   part_rows: int, mode: str) -> None:
    rows = numbered(tasks, key, [c for c in order if c in tasks.columns])
    part = F.floor(F.col("seq") / part_rows)
    message = F.to_json(F.struct(*rows.columns)).alias("value")
    (rows.repartition(key, part).sortWithinPartitions(key, "seq").select(message)
     .write.mode(mode).text(folder))


def publish_once(tasks: DataFrame, topic: str, batch: str, key: str = "ticker",
                 order: Sequence[str] = ("created_at_ts", "url")) -> None:
    """Publish a batch under its name, unless it is there whole.

    A batch that was cut short is written anew; nobody has read it, as a topic is drained after
    its batch is complete.
    """
    if not published(tasks.sparkSession, topic, batch):
        write_messages(tasks, f"{topic}/batch={batch}", key, order, PART_ROWS, "overwrite")


def published(spark: SparkSession, topic: str, batch: str) -> bool:
    """Whether a batch has been published whole."""
    return _exists(spark, f"{topic}/batch={batch}/_SUCCESS")


def claim_checks(spark: SparkSession, topic: str, schema: str = MESSAGE_SCHEMA,
                 files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Stream of parsed messages; NULL values and text that is not JSON are skipped."""
    lines = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(topic)
    )
    return parse_messages(lines, schema)


def parse_messages(lines: DataFrame, schema: str = MESSAGE_SCHEMA) -> DataFrame:
    parsed = F.from_json("value", f"{schema}, _corrupt string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.where(F.col("value").isNotNull()).select(parsed.alias("m"))
    return rows.where(F.col("m").isNotNull() & F.col("m._corrupt").isNull()).select(
        "m.*").drop("_corrupt")


def distinct_messages(messages: DataFrame, key: Sequence[str] = MESSAGE_KEY,
                      within: str = f"{RETENTION_HOURS} hours") -> DataFrame:
    """A stream that lets each message through once, however often it is published.

    Messages are told apart by ``key`` and remembered until the watermark, ``within`` behind the
    newest of them, has passed theirs; older ones that come later are left out.
    """
    timed = messages.withColumn("_created", F.coalesce(
        F.try_to_timestamp("created_at_ts"), F.to_timestamp(F.lit("1970-01-01 00:00:00"))))
    return (timed.withWatermark("_created", within)
            .dropDuplicatesWithinWatermark(list(key)).drop("_created"))


def split_failures(batch: DataFrame, ok: str = "ok") -> tuple[DataFrame, DataFrame]:
    """Rows whose fetch succeeded, and the rest; an unknown outcome is a failure."""
    good = F.coalesce(F.col(ok), F.lit(False))
    return batch.where(good).drop(ok), batch.where(~good).drop(ok)


def _overwrite_batch(df: DataFrame, folder: str, epoch: int, kind: str) -> None:
    """Write one micro-batch to its own folder; a replayed batch replaces its first try."""
    target = f"{folder}/epoch={epoch:09d}"
    if kind == "json":
        lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
        lines.write.mode("overwrite").text(target)
    else:
        df.write.mode("overwrite").parquet(target)


def load_pass(messages: DataFrame, fetch: Callable[[DataFrame], DataFrame], landing: str,
              errors: str, checkpoint: str,
              transform: Callable[[DataFrame], DataFrame] | None = None,
              attempt: int = 1) -> StreamingQuery:
    """Drain a message stream: fetched rows to the landing folder, failures to the next topic.

    ``fetch`` adds the payload columns, a boolean ``ok`` and, if it knows one, a ``reason``.
    A failed message goes on with the number of the attempt and the reason.  Each
    micro-batch is written before its position is committed, and written under its own
    number, so that a batch replayed after a crash leaves one copy.
    """
    columns = messages.columns

    def load(batch: DataFrame, epoch: int) -> None:
        fetched = fetch(batch).persist()
        try:
            good, bad = split_failures(fetched)
            _overwrite_batch(transform(good) if transform else good, landing, epoch, "parquet")
            reason = F.col("reason") if "reason" in bad.columns else F.lit(None).cast("string")
            _overwrite_batch(bad.select(
                *columns, F.lit(attempt).alias("attempt"),
                F.coalesce(reason, F.lit(FETCH_FAILED)).alias("reason")), errors, epoch, "json")
        finally:
            fetched.unpersist()

    return (
        messages.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_with_retry(spark: SparkSession, topic: str, landing: str, checkpoint: str,
                    fetch: Callable[[DataFrame], DataFrame],
                    retry_fetch: Callable[[DataFrame], DataFrame] | None = None,
                    schema: str = MESSAGE_SCHEMA,
                    transform: Callable[[DataFrame], DataFrame] | None = None,
                    files_per_trigger: int = FILES_PER_TRIGGER,
                    once: Sequence[str] | None = None,
                    within: str = f"{RETENTION_HOURS} hours") -> dict[str, str]:
    """Two passes: the topic first, then its failures; what fails twice goes to ``_dlq``.

    With ``once``, messages that repeat these columns are loaded once.
    """
    folders = {
        "first": f"{landing}/pass=first", "retried": f"{landing}/pass=retry",
        "retry": f"{topic}_retry", "dlq": f"{topic}_dlq",
    }
    first = claim_checks(spark, topic, schema, files_per_trigger)
    if once:
        first = distinct_messages(first, once, within)
    load_pass(first, fetch, folders["first"], folders["retry"], f"{checkpoint}/first",
              transform).awaitTermination()
    if _exists(spark, folders["retry"]):
        again = claim_checks(spark, f"{folders['retry']}/*", schema, files_per_trigger)
        load_pass(again, retry_fetch or fetch, folders["retried"], folders["dlq"],
                  f"{checkpoint}/retry", transform, attempt=2).awaitTermination()
    return folders


def landed(spark: SparkSession, landing: str) -> DataFrame | None:
    """What ``load_with_retry`` has landed, with ``pass`` and ``epoch``; None if nothing."""
    if not _exists(spark, landing):
        return None
    rows = spark.read.option("mergeSchema", "true").parquet(landing)
    return rows if "ticker" in rows.columns else None


def messages_in(spark: SparkSession, topic: str) -> DataFrame | None:
    """The failed messages of a topic; None if there have been none."""
    return parse_messages(spark.read.text(f"{topic}/*")) if _exists(spark, topic) else None


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def compact_log(log: DataFrame, key: str, ts: str, as_of: datetime,
                hours: int = RETENTION_HOURS) -> DataFrame:
    """Newest message per key within the retention time.

    The newest row is picked by a combining aggregate, so a busy key is not gathered.
    """
    rest = [c for c in log.columns if c not in (key, ts)]
    live = log.where(F.col(ts) >= F.lit(as_of - timedelta(hours=hours)))
    best = live.groupBy(key).agg(F.max(F.struct(ts, *rest)).alias("_m"))
    return best.select(key, *[F.col(f"_m.{c}").alias(c) for c in (ts, *rest)])


def compact_stream(messages: DataFrame, key: str, ts: str, store: Warehouse, checkpoint: str,
                   as_of: datetime, hours: int = RETENTION_HOURS) -> StreamingQuery:
    """Append each batch's newest message per key to the news of a compacted copy.

    A batch costs its own size, whatever the size of the copy; ``fold_log`` takes the news in.  A
    replayed batch replaces its first try.
    """
    spec = TableSpec(LOG_NEWS, "", (), ())

    def add(batch: DataFrame, epoch: int) -> None:
        # a micro-batch has a session of its own
        store.of(batch.sparkSession).append(compact_log(batch, key, ts, as_of, hours), spec, batch=f"{epoch:09d}")

    return (
        messages.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compacted_log(store: Warehouse, key: str, ts: str, as_of: datetime,
                  hours: int = RETENTION_HOURS) -> DataFrame:
    """The newest message per key, of the copy and the news."""
    parts = [store.read_or_none(LOG), store.read_or_none(LOG_NEWS)]
    held = [p.drop(LOAD) for p in parts if p is not None]
    if not held:
        raise FileNotFoundError("nothing has been compacted")
    both = held[0] if len(held) == 1 else held[0].unionByName(held[1])
    return compact_log(both, key, ts, as_of, hours)


def fold_log(store: Warehouse, key: str, ts: str, as_of: datetime,
             hours: int = RETENTION_HOURS) -> DataFrame:
    """Publish the compacted copy with the news, then drop the news it holds.

    Taking news in twice changes nothing, so a crash between the two steps does no harm.
    """
    store.refresh(LOG_NEWS)
    news = store.read(LOG_NEWS).select(LOAD).distinct().collect()
    store.replace(compacted_log(store, key, ts, as_of, hours), TableSpec(LOG, "", (), ()))
    store.drop_partitions(LOG_NEWS, news)
    return store.read(LOG)
