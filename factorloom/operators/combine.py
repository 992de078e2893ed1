"""Joins and set operations.

No join carries an unconditional broadcast hint.  Sides that are small in use, a benchmark's days
or a lookup table, are stored and broadcast if their files are small (``session.small_side``);
elsewhere Spark decides by its own size statistics or, at run time, by shuffle sizes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.session import small_side


def left_dims(fact: DataFrame, dims: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(lambda left, right: left.join(right, list(keys), "left"), dims, fact)


def full_outer_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer joins on shared key names, keys coalesced across all inputs."""
    return reduce(lambda left, right: left.join(right, list(keys), "full"), frames)


def restrict_to(df: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``allowed``; repeated keys there do not multiply rows."""
    return df.join(allowed.select(*keys), list(keys), "left_semi")


def with_benchmark(series: DataFrame, benchmark: DataFrame, day: str = "date",
                   prefix: str = "mkt_") -> DataFrame:
    """Attach the benchmark's row of the same day.

    The benchmark is reduced to one row per day first, so that side grows with the calendar only.
    """
    values = [c for c in benchmark.columns if c != day]
    picked = F.max(F.struct(*values)).alias("_v")
    daily = benchmark.groupBy(day).agg(picked).select(
        day, *[F.col(f"_v.{c}").alias(f"{prefix}{c}") for c in values]
    )
    return series.join(small_side(daily), day)


def lookup_left(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows with the columns of a lookup table, which may be of any size but is small in use: a
    key with a third of the rows then needs no shuffle."""
    return df.join(small_side(table), key, "left")


def join_where(left: DataFrame, right: DataFrame, keys: Sequence[str],
               condition: Column) -> DataFrame:
    """Inner join on key names with one more condition on the right side."""
    return left.join(right.where(condition), list(keys))


def missing_keys(expected: DataFrame, state: DataFrame, key: str = "ticker") -> DataFrame:
    """Expected keys that have no state row yet."""
    return expected.select(key).distinct().join(state.select(key), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None,
            where: Column | None = None) -> DataFrame:
    """Child rows whose key exists in no parent row; NULL keys are not orphans."""
    rows = child if where is None else child.where(where)
    known = parent.select(F.col(parent_key or child_key).alias(child_key))
    return rows.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def orphan_locations(inventory: DataFrame, live: DataFrame, prefix: str,
                     column: str = "location") -> DataFrame:
    """Distinct stored paths that no live path refers to once the prefix is stripped."""
    stripped = live.select(F.replace(F.col(column), F.lit(prefix), F.lit("")).alias(column))
    return inventory.select(column).subtract(stripped)


def union_runs(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_delta(reference: DataFrame, state: DataFrame, key: str = "ticker",
              status: str = "ticker_status") -> DataFrame:
    """One row per key with what changed between the reference set and the state table."""
    ref = reference.select(key).distinct().withColumn("_in_ref", F.lit(True))
    held = state.select(key, F.col(status).alias("_status")).withColumn("_held", F.lit(True))
    new = F.col("_held").isNull()
    gone = F.col("_in_ref").isNull()
    change = (
        F.when(new, "new").when(gone, "disappeared")
        .when(F.col("_status") == "inactive", "reappeared").otherwise("unchanged")
    )
    return ref.join(held, key, "full").select(key, change.alias("change"))


def assemble(base: DataFrame, steps: Sequence[tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """Chain of USING joins: (frame, keys, how)."""
    return reduce(lambda left, s: left.join(s[0], list(s[1]), s[2]), steps, base)
