"""Typing, normalising, slicing and stamping rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.catalogue import Indicator
from factorloom.context import RunContext
from factorloom.functions.exprs import (
    QUALIFIED,
    absolute_month,
    absolute_quarter,
    catalogue_text,
    quoted,
)

# Start of time for an empty target, key pattern.
EPOCH = "1900-01-01 00:00:00"
TICKER_PATTERN = "^[A-Z0-9]{3}$"

# Audit column names per layer.
_AUDIT = {
    "staging": ("staged_at", "staging_invocation_id"),
    "silver": ("silver_updated_at", "silver_invocation_id"),
    "intermediate": ("int_updated_at", "int_invocation_id"),
    "gold": ("gold_updated_at", "gold_invocation_id"),
}


def extract_fields(
    df: DataFrame, doc: str, catalogue: Sequence[Indicator], keep: Sequence[str | Column]
) -> DataFrame:
    """``keep`` columns plus typed columns from a JSON text column.

    All fields are read as text in one parse of the document and cast afterwards, so a value
    that does not cast becomes NULL without costing its neighbours.
    """
    schema = ", ".join(f"`{i.source}` string" for i in catalogue)
    parsed = df.select(*keep, F.from_json(doc, schema).alias("_doc"))
    kept = [c for c in parsed.columns if c != "_doc"]
    fields = [f"try_cast(_doc.`{i.source}` AS {i.type}) AS {i.alias}" for i in catalogue]
    return parsed.selectExpr(*kept, *fields)


def try_cast_cols(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def normalize_key(df: DataFrame, key: str = "ticker") -> DataFrame:
    return df.withColumn(key, catalogue_text(key))


def regex_filter(df: DataFrame, key: str, pattern: str = TICKER_PATTERN,
                 not_null: Sequence[str] = ()) -> DataFrame:
    keep = F.col(key).isNotNull() & F.col(key).rlike(pattern)
    for c in not_null:
        keep &= F.col(c).isNotNull()
    return df.where(keep)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULLs to defaults, the default taking the type of its column."""
    items = []
    for name, kind in df.dtypes:
        if name in defaults:
            value = defaults[name]
            value = quoted(value) if isinstance(value, str) else value
            items.append(f"coalesce({name}, CAST({value} AS {kind})) AS {name}")
        else:
            items.append(f"`{name}`")
    return df.selectExpr(*items)


def latest_value(df: DataFrame, ts: str) -> Column:
    """Largest ``ts`` of a table as a scalar subquery; an empty table is an error."""
    top = F.max(ts)
    message = F.lit(f"no {ts}: the source is empty")
    return df.agg(F.when(top.isNull(), F.raise_error(message)).otherwise(top)).scalar()


def recent_slice(df: DataFrame, ts: str = "bronze_ingested_time", days: int = 2) -> DataFrame:
    """Rows no older than ``days`` before the newest row of the table."""
    return df.where(F.col(ts) >= latest_value(df, ts) - F.expr(f"interval {days} days"))


def high_watermark(target: DataFrame, ts: str) -> Column:
    """Largest ``ts`` already in the target, the start of time for an empty one."""
    kind = dict(target.dtypes)[ts]
    return target.agg(F.coalesce(F.max(ts), F.lit(EPOCH).cast(kind))).scalar()


def incremental_slice(source: DataFrame, target: DataFrame | None, source_ts: str,
                      target_ts: str | None = None) -> DataFrame:
    """Source rows newer than the target; the whole source when there is no target."""
    if target is None:
        return source
    return source.where(F.col(source_ts) > high_watermark(target, target_ts or source_ts))


def with_audit(df: DataFrame, layer: str, ctx: RunContext) -> DataFrame:
    """Layer time stamp and run id; times stay UTC and are shifted only for display."""
    if layer not in _AUDIT:
        raise ValueError(f"unknown layer {layer!r}, expected one of {sorted(_AUDIT)}")
    at, by = _AUDIT[layer]
    return df.withColumns({at: F.lit(ctx.started_at), by: F.lit(ctx.run_id)})


def audit_names(layer: str) -> tuple[str, str]:
    return _AUDIT[layer]


def exclude_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def with_presence_flag(df: DataFrame, name: str) -> DataFrame:
    """Constant marker that turns NULL when an outer join finds no partner."""
    return df.withColumn(name, F.lit(1))


def qualified_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == QUALIFIED)


def with_period_index(df: DataFrame, day: str = "date") -> DataFrame:
    """Calendar parts plus gap-free month and quarter counters."""
    year, month, quarter = (f(day).cast("bigint") for f in (F.year, F.month, F.quarter))
    return df.withColumns({
        "year": year,
        "month": month,
        "quarter": quarter,
        "absolute_month": absolute_month(year, month),
        "absolute_quarter": absolute_quarter(year, quarter),
    })


def round_outputs(df: DataFrame, columns: Mapping[str, str] | Sequence[str],
                  digits: int = 3) -> DataFrame:
    """Half-up rounding of score columns, optionally renamed (out -> source)."""
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    return df.withColumns({out: F.round(src, digits) for out, src in names.items()})
