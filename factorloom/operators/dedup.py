"""One row per key, as an aggregate rather than a sort window.

``max(struct)`` combines on the map side, so a key holding a third of all rows reaches its
reducer as one row per map task instead of one huge window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PICK = "_pick"


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # The whole row follows the order columns in the struct: equal order values still give
    # the same winner on every run.
    row = F.struct(*rest) if rest else F.lit(1)
    ranked = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], row.alias("row"))
    best = df.groupBy(*keys).agg(pick(ranked).alias(_PICK))
    values = [F.col(f"{_PICK}.row.{c}").alias(c) for c in rest]
    return best.select(*keys, *values).select(*df.columns)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the largest ``order`` values per key, NULLs counting as oldest."""
    return _pick(df, keys, [F.col(c) for c in order], F.max)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the smallest ``order`` values per key, NULLs last."""
    ascending = [x for c in order for x in (F.col(c).isNull(), F.col(c))]
    return _pick(df, keys, ascending, F.min)


def last_in_period(df: DataFrame, key: Sequence[str], period: Sequence[str],
                   day: str = "date") -> DataFrame:
    """Last dated row per key and period."""
    return dedup_latest(df, [*key, *period], [day])


def latest_per_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    return dedup_latest(df, key, [order])
