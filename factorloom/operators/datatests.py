"""Assertions over tables: each returns the rows that break it.

``checks`` states the same tests as data and counts their failures together.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.operators import aggregates, combine


def _rows(df: DataFrame, where: Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def not_null(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    return _rows(df, where).where(F.col(column).isNull())


def null_if(df: DataFrame, column: str, where: Column) -> DataFrame:
    return df.where(where & F.col(column).isNotNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return aggregates.duplicates(df.where(F.col(column).isNotNull()), [column])


def compound_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated key tuples; a tuple of only NULLs is ignored."""
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])
    return aggregates.duplicates(df.where(some), columns)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their row counts."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(~F.col(column).isin(*values))


def relationships(child: DataFrame, parent: DataFrame, column: str,
                  parent_column: str | None = None, where: Column | None = None) -> DataFrame:
    return combine.orphans(child, parent, column, parent_column, where)


def regex(df: DataFrame, column: str, pattern: str, where: Column | None = None) -> DataFrame:
    return _rows(df, where).where(~F.col(column).rlike(pattern))


def between(df: DataFrame, column: str, low=None, high=None,
            where: Column | None = None) -> DataFrame:
    """Values outside the range; an open end is not checked."""
    ok = F.lit(True)
    if low is not None:
        ok &= F.col(column) >= low
    if high is not None:
        ok &= F.col(column) <= high
    return _rows(df, where).where(~ok)


def in_set(df: DataFrame, column: str, values: Sequence, where: Column | None = None) -> DataFrame:
    return _rows(df, where).where(~F.col(column).isin(*values))


def columns_contain(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required columns the table lacks (from the schema, no data is read)."""
    missing = [c for c in required if c not in df.columns]
    return df.sparkSession.createDataFrame([(c,) for c in missing], "column_name string")


def row_count_between(df: DataFrame, low: int, high: int) -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return total.where(~F.col("n_rows").between(low, high))


def distinct_count(df: DataFrame, column: str, expected: int) -> DataFrame:
    counts = aggregates.distinct_count(df, column)
    return counts.where(F.col("n_distinct") != expected)


def pair_greater(df: DataFrame, a: str, b: str, or_equal: bool = True) -> DataFrame:
    ok = F.col(a) >= F.col(b) if or_equal else F.col(a) > F.col(b)
    return df.where(~ok)


def recent(df: DataFrame, ts: str, as_of: datetime, days: int = 32) -> DataFrame:
    """Newest time stamp not in the future, returned when older than ``days``."""
    newest = df.where(F.col(ts) <= F.lit(as_of)).agg(F.max(ts).alias("max_timestamp"))
    floor = F.lit("1970-01-01 00:00:00").cast("timestamp")
    stale = F.coalesce(F.col("max_timestamp").cast("timestamp"), floor)
    return newest.where(stale < F.lit(as_of - timedelta(days=days)))


def null_rate(df: DataFrame, column: str) -> DataFrame:
    return aggregates.rate_bps(df, F.col(column).isNull())


def invalid_rate(df: DataFrame, column: str, value) -> DataFrame:
    return aggregates.rate_bps(df, F.col(column) == value)
