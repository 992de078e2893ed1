"""Column expressions with the semantics the factor models need."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Row status words and the separator between reasons.
QUALIFIED = "qualified"
UNQUALIFIED = "unqualified"
REASON_SEPARATOR = " | "


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: ColumnLike, den: ColumnLike, mode: str = "double") -> Column:
    """``num / den`` with a NULL result for a zero divisor.

    ``double`` divides in floating point; ``decimal4`` gives a decimal with four digits,
    which creates the rank ties of fixed-scale decimal division.
    """
    num, den = col(num), col(den)
    if mode == "decimal4":
        # Operands of 28 digits leave the quotient ten decimals, enough to round once.
        exact = num.cast("decimal(28,6)") / F.nullif(den.cast("decimal(28,6)"), F.lit(0))
        return F.round(exact, 4).cast("decimal(38,4)")
    if mode != "double":
        raise ValueError(f"unknown ratio mode {mode!r}")
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def positive_ln(x: ColumnLike) -> Column:
    """Natural logarithm, NULL for zero and negative input."""
    x = col(x).cast("double")
    return F.when(x > 0, F.ln(x))


def strict_greatest(a: ColumnLike, b: ColumnLike) -> Column:
    """Greatest of two values, NULL when either is NULL."""
    a, b = col(a), col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


class Computed(str):
    """A rule message given as a SQL expression instead of a fixed text."""


def quoted(text: str) -> str:
    body = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{body}'"


def reason(rules: Iterable[tuple[str, str]]) -> Column:
    """Messages of all rules that hold, joined in order; NULL when none does.

    A rule is a SQL condition and its message.  All rules become one expression text, which
    costs one call to the JVM for a table of any width.
    """
    parts = [
        f"CASE WHEN {cond} THEN {m if isinstance(m, Computed) else quoted(m)} END"
        for cond, m in rules
    ]
    return F.expr(f"nullif(concat_ws('{REASON_SEPARATOR}', {', '.join(parts)}), '')")


def status_of(reason_col: ColumnLike) -> Column:
    why = col(reason_col)
    clean = why.isNull() | (why == "")
    return F.when(clean, F.lit(QUALIFIED)).otherwise(F.lit(UNQUALIFIED))


def absolute_quarter(year: ColumnLike, quarter: ColumnLike) -> Column:
    return col(year).cast("bigint") * 4 + col(quarter).cast("bigint")


def absolute_month(year: ColumnLike, month: ColumnLike) -> Column:
    return col(year).cast("bigint") * 12 + col(month).cast("bigint")


def null_rules(columns: Sequence[str], message: str = "{} is null") -> list[tuple[str, str]]:
    return [(f"{c} IS NULL", message.format(c)) for c in columns]


def catalogue_text(x: ColumnLike) -> Column:
    """Key normalisation: upper case without surrounding blanks."""
    return F.trim(F.upper(col(x)))


def one_line_query(text: ColumnLike) -> Column:
    """Query text without block comments, whitespace runs collapsed to one blank."""
    # Fixed patterns: block comment, whitespace run.
    bare = F.regexp_replace(F.coalesce(col(text), F.lit("")), r"/\*[\s\S]*?\*/", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))
