"""Appends, merges, schema changes and history tables as joins."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.operators.clean import incremental_slice


def append_incremental(source: DataFrame, target: DataFrame | None, source_ts: str,
                       target_ts: str | None = None) -> DataFrame:
    """Target plus the source rows newer than its high watermark."""
    fresh = incremental_slice(source, target, source_ts, target_ts)
    return fresh if target is None else sync_all_columns(target, fresh).unionByName(fresh)


def merge_latest(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert by key: a source row replaces the whole target row of its key.

    NULL is a key like any other.
    """
    t, s = target.alias("t"), source.select(*keys).alias("s")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    kept = t.join(s, same, "left_anti")
    return sync_all_columns(kept, source).unionByName(source)


def touched_history(history: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All stored rows of the keys a new slice touches.

    Feeding these to a rebuild keeps indicators a partial redelivery does not repeat.
    """
    return history.join(fresh.select(*keys), list(keys), "left_semi")


def sync_all_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target with the source's columns: missing ones as NULL, removed ones dropped."""
    held = set(target.columns)
    return target.select(*[
        F.col(f.name) if f.name in held else F.lit(None).cast(f.dataType).alias(f.name)
        for f in source.schema
    ])


def _null_safe_equal(columns: Sequence[str], left: str, right: str) -> Column:
    pairs = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a & b, pairs)


def snapshot_columns(current: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in current.columns if c not in keys]


def scd2_open(current: DataFrame, as_of: datetime) -> DataFrame:
    """First snapshot: every row is an open version."""
    return current.withColumns({
        "valid_from": F.lit(as_of),
        "valid_to": F.lit(None).cast("timestamp"),
        "is_deleted": F.lit(False),
    })


def scd2(history: DataFrame | None, current: DataFrame, keys: Sequence[str],
         check_cols: Sequence[str], as_of: datetime,
         hard_deletes: str = "invalidate") -> DataFrame:
    """History after comparing its open versions with the current rows.

    A key whose ``check_cols`` differ gets its version closed and a new one opened.  A key
    that vanished stays as it is (``ignore``), is closed (``invalidate``), or is closed and
    followed by a version marked deleted (``new_record``).  A key that returns opens a new
    version.  ``current`` holds one row per key.
    """
    if hard_deletes not in ("ignore", "invalidate", "new_record"):
        raise ValueError(f"unknown hard_deletes mode {hard_deletes!r}")
    if history is None:
        return scd2_open(current, as_of)
    payload = snapshot_columns(current, keys)
    versions = [*keys, *payload, "valid_from", "valid_to", "is_deleted"]
    history = history.select(*versions)
    is_open = F.col("valid_to").isNull()
    past = history.where(~is_open)

    old = history.where(is_open).withColumn("_old", F.lit(True)).alias("o")
    new = current.withColumn("_new", F.lit(True)).alias("n")
    match = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys])
    both = old.join(new, match, "full")

    held, seen = F.col("o._old").isNotNull(), F.col("n._new").isNotNull()
    deleted = F.coalesce(F.col("o.is_deleted"), F.lit(False))
    same = _null_safe_equal(check_cols, "o", "n") & ~deleted
    now, never = F.lit(as_of), F.lit(None).cast("timestamp")

    def version(side: str, start: Column, end: Column, gone: Column) -> Column:
        body = [F.col(f"{side}.{c}").alias(c) for c in (*keys, *payload)]
        return F.struct(*body, start.alias("valid_from"), end.alias("valid_to"),
                        gone.alias("is_deleted"))

    kept = version("o", F.col("o.valid_from"), never, deleted)
    closed = version("o", F.col("o.valid_from"), now, deleted)
    opened = version("n", now, never, F.lit(False))
    removed = version("o", now, never, F.lit(True))
    after_delete = {
        "ignore": F.array(kept),
        "invalidate": F.array(closed),
        "new_record": F.when(deleted, F.array(kept)).otherwise(F.array(closed, removed)),
    }[hard_deletes]
    rows = (
        F.when(~held, F.array(opened))
        .when(~seen, after_delete)
        .when(same, F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    current_versions = both.select(F.explode(rows).alias("_v")).select("_v.*")
    return past.unionByName(current_versions)


def changed_keys(history: DataFrame, since: datetime, key: str = "ticker",
                 positive: Sequence[str] = ("cash_dividend", "stock_dividend")) -> DataFrame:
    """Keys with a version opened or closed since a time and any positive amount in it."""
    moved = (F.col("valid_from") >= F.lit(since)) | (F.col("valid_to") >= F.lit(since))
    amount = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in positive])
    return history.where(moved & amount).select(key).distinct()
