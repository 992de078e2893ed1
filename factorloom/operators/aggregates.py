"""Grouped and whole-table aggregates; all of them combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.catalogue import Indicator


def pivot_eav(df: DataFrame, keys: Sequence[str], catalogue: Sequence[Indicator],
              id_col: str = "indicator_id", value: str = "value") -> DataFrame:
    """Attribute rows to one wide row per key: a single hash aggregate, no value discovery."""
    cells = [
        F.expr(f"max(CASE WHEN {id_col} = {int(i.source)} THEN CAST({value} AS {i.type}) END)"
               f" AS {i.alias}")
        for i in catalogue
    ]
    return df.groupBy(*keys).agg(*cells)


def max_by_key(df: DataFrame, key: Sequence[str], ts: str, out: str,
               where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.groupBy(*key).agg(F.max(ts).alias(out))


def min_max_group(df: DataFrame, keys: Sequence[str], column: str, first: str,
                  last: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(column).alias(first), F.max(column).alias(last))


def distinct_count(df: DataFrame, column: str, out: str = "n_distinct") -> DataFrame:
    return df.agg(F.count_distinct(column).alias(out))


def rate_bps(df: DataFrame, failing: Column, out: str = "failure_bps") -> DataFrame:
    """Share of failing rows in basis points, cut to an integer; NULL for an empty table."""
    bad = F.count(F.when(failing, 1)).alias("_bad")
    counts = df.agg(bad, F.count(F.lit(1)).alias("_all"))
    return counts.select(F.expr("(_bad * 10000) div nullif(_all, 0)").cast("int").alias(out))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def duplicates(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def global_extrema(df: DataFrame, **outs: str) -> DataFrame:
    return df.agg(*[F.max(c).alias(o) for o, c in outs.items()])
