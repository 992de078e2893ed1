"""Nested payloads to flat landing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.context import RunContext
from factorloom.functions.exprs import ColumnLike, col


def explode_records(df: DataFrame, column: str = "data", keep_empty: bool = True) -> DataFrame:
    """One row per list element; an empty or NULL list keeps one row with a NULL element."""
    explode = F.explode_outer if keep_empty else F.explode
    return df.withColumn(column, explode(column))


def unnest_struct(df: DataFrame, column: str = "data") -> DataFrame:
    """Replace a struct column by its fields."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, f"{column}.*")


def struct_to_json(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, F.to_json(F.col(column), {"ignoreNullFields": "false"}))


def payload_to_json(df: DataFrame, column: str = "data") -> DataFrame:
    """Keep a whole payload, list or struct, as JSON text."""
    return struct_to_json(df, column)


def parse_iso_ts(text: ColumnLike) -> Column:
    """ISO-8601 text to timestamp; unparsable text gives NULL."""
    return F.try_to_timestamp(col(text))


def with_event_date(df: DataFrame, field: str = "data.date") -> DataFrame:
    """Date and year columns taken from a date field inside the record struct."""
    day = F.to_date(parse_iso_ts(field))
    return df.withColumns({"event_date": day, "year": F.year(day)})


def stamp_ingest_time(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumn("bronze_ingested_time", F.lit(ctx.started_at))


def flatten_reports(df: DataFrame, data: str = "data", values: str = "values") -> DataFrame:
    """List of indicators, each with a list of period values, to entity-attribute-value rows."""
    wide = unnest_struct(explode_records(df, data), data)
    deep = unnest_struct(explode_records(wide, values), values)
    typed = {
        "indicator_id": F.col("id").cast("int"),
        "indicator_name": F.col("name"),
        "year": F.col("year").cast("int"),
        "quarter": F.col("quarter").cast("int"),
        "value": F.col("value").cast("double"),
    }
    return deep.withColumns(typed).drop("id", "name")


def flatten_quotes(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Daily quote lists to one JSON document per entity and day."""
    rows = with_event_date(explode_records(df))
    return stamp_ingest_time(struct_to_json(rows, "data"), ctx)


def flatten_fundamental_quarter(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Quarterly metric lists to one JSON document per entity and quarter."""
    rows = unnest_struct(explode_records(df))
    rows = struct_to_json(rows, "financialValues", "value").drop("financialValues")
    periods = {c: F.col(c).cast("int") for c in ("year", "quarter")}
    return stamp_ingest_time(rows.withColumns(periods), ctx)


def flatten_dividends(df: DataFrame, ctx: RunContext) -> DataFrame:
    rows = explode_records(df).withColumn("year", F.col("data.year").cast("int"))
    return stamp_ingest_time(struct_to_json(rows, "data"), ctx)
