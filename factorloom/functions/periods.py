"""Reporting-period arithmetic as columns over an explicit date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factorloom.functions.exprs import ColumnLike, absolute_quarter, col

# Trading days per calendar year, slack rows, extra quarters, look-back years.
TRADING_DAYS = 250
CALENDAR_DAYS = 365
SLACK_ROWS = 20
EXTRA_QUARTERS = 2
LOOKBACK_YEARS = 8


def previous_quarter(day: ColumnLike) -> tuple[Column, Column]:
    """(year, quarter) of the last completed quarter before ``day``."""
    year, quarter = F.year(col(day)), F.quarter(col(day))
    first = quarter == 1
    return (
        F.when(first, year - 1).otherwise(year).cast("bigint"),
        F.when(first, F.lit(4)).otherwise(quarter - 1).cast("bigint"),
    )


def previous_year(day: ColumnLike) -> Column:
    return (F.year(col(day)) - 1).cast("bigint")


def fallback_year(day: ColumnLike, lookback: int = LOOKBACK_YEARS) -> Column:
    return (F.year(col(day)) - lookback).cast("bigint")


def quarters_to_fetch(start: ColumnLike, day: ColumnLike) -> Column:
    """Quarters between the start date and the last completed quarter, plus two."""
    year, quarter = previous_quarter(day)
    begin = absolute_quarter(F.year(col(start)), F.quarter(col(start)))
    return absolute_quarter(year, quarter) - begin + EXTRA_QUARTERS


def years_to_fetch(start: ColumnLike, day: ColumnLike) -> Column:
    return previous_year(day) - F.year(col(start)).cast("bigint") + 1


def trading_days_to_fetch(start: ColumnLike, day: ColumnLike) -> Column:
    """Estimated sessions up to the day before ``day``; NULL when the start lies later."""
    days = F.datediff(F.date_sub(col(day), 1), col(start))
    sessions = F.floor(days * F.lit(TRADING_DAYS / CALENDAR_DAYS)) + SLACK_ROWS
    return F.when(days >= 0, sessions.cast("bigint"))
