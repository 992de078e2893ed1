"""Query registration and SQL assembly."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factorloom.session import prepare


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    """A named SQL fragment; fragments may use tables and fragments defined before them."""
    CTES[name] = body.strip()


def sql(final: str) -> str:
    """``final`` with the fragments it uses, directly or through others, as WITH items."""
    needed: set[str] = set()
    pending = [final]
    while pending:
        text = pending.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(CTES[name])
    items = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in CTES.items() if n in needed)
    return f"WITH {items}\n{final}" if items else final


def query(name: str, oracle: str | None = None):
    """Register a query under its key, with its SQL counterpart where SQL can express it."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = sql(oracle.strip())
        return fn

    return wrap


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison; adding 0 turns a negative zero into zero."""
    return df.withColumns({c: r(F.col(c), digits) for c in columns})


def r(column: Column, digits: int = 6) -> Column:
    return F.round(column.cast("double"), digits) + F.lit(0.0)


def rs(*columns: str, digits: int = 6) -> str:
    """The SQL counterpart of ``rounded``: select items."""
    return ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in columns)
