"""Counts per window of event time, over a stream that may bring rows late.

A watermark trails the newest event time by ``lateness``.  A window is given out once, when the
watermark has passed its end (append mode); rows that come after that are left out, rows that
come before, in whatever order, count.  State holds the open windows only, and is restored from the
checkpoint after a restart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LATENESS = "2 hours"


def _counts(events: DataFrame, ts: str, frame: Column, keys: Sequence[str], lateness: str,
            total: str | None) -> DataFrame:
    sums = [] if total is None else [F.sum(F.col(total).cast("decimal(18,2)")).alias("total")]
    return (
        events.withWatermark(ts, lateness)
        .groupBy(frame.alias("_window"), *keys)
        .agg(F.count(F.lit(1)).alias("n_events"), *sums)
        .select(F.col("_window.start").alias("window_start"),
                F.col("_window.end").alias("window_end"), *keys, "n_events",
                *[F.col("total").cast("double").alias("total") for _ in sums])
    )


def tumbling_counts(events: DataFrame, ts: str, length: str, keys: Sequence[str] = (),
                    lateness: str = LATENESS, total: str | None = None) -> DataFrame:
    """Each event in the one window of ``length`` that holds it."""
    return _counts(events, ts, F.window(ts, length), keys, lateness, total)


def sliding_counts(events: DataFrame, ts: str, length: str, slide: str,
                   keys: Sequence[str] = (), lateness: str = LATENESS,
                   total: str | None = None) -> DataFrame:
    """Each event in every window of ``length``, begun every ``slide``, that holds it."""
    return _counts(events, ts, F.window(ts, length, slide), keys, lateness, total)


def session_counts(events: DataFrame, ts: str, gap: str, keys: Sequence[str],
                   lateness: str = LATENESS, total: str | None = None) -> DataFrame:
    """Runs of a key's events, none more than ``gap`` after the one before.

    A session ends ``gap`` after its last event.  A late event may join two open sessions.
    """
    return _counts(events, ts, F.session_window(ts, gap), keys, lateness, total)


def append_windows(counts: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append finished windows to a folder; drains what is there and stops."""
    return (
        counts.writeStream.outputMode("append").format("parquet")
        .option("path", folder).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
