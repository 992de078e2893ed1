"""Row rules: every broken rule adds its message to one reason column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from factorloom.catalogue import (
    DIVIDEND,
    FUNDAMENTAL_1,
    FUNDAMENTAL_2,
    FUNDAMENTAL_QUARTER,
    HISTORICAL_QUOTES,
    STATEMENTS,
    Identity,
    Indicator,
)
from factorloom.functions.exprs import (
    UNQUALIFIED,
    Computed,
    null_rules,
    reason,
    status_of,
)

# A SQL condition and the message it adds.
Rule = tuple[str, str]
REASON = "unqualified_reason"

# Listing venues, tolerance of the accounting identities, screening limits.
EXCHANGES = ("UPCOM", "HSX", "HOSE", "HNX")
TOLERANCE = 0.01
STANDARD_COMPANY = "CT"
MIN_MARKET_CAP = 500_000_000_000
MIN_AVG_VOLUME = 10_000


def apply_rules(df: DataFrame, rules: Sequence[Rule], reason_col: str = REASON,
                with_status: bool = True) -> DataFrame:
    df = df.withColumn(reason_col, reason(rules))
    return df.withColumn("status", status_of(reason_col)) if with_status else df


def mandatory(indicators: Sequence[Indicator], message: str) -> list[Rule]:
    return null_rules([i.alias for i in indicators if i.required], message)


def non_negative(indicators: Sequence[Indicator]) -> list[Rule]:
    return [
        (f"{i.alias} < 0", f"{i.alias} cannot be negative")
        for i in indicators if i.non_negative
    ]


def _or_zero(name: str) -> str:
    return f"coalesce({name}, 0)"


def identity_rules(identities: Sequence[Identity], tolerance: float = TOLERANCE) -> list[Rule]:
    """Rows whose total differs from its signed terms by more than the tolerance of the base."""
    rules = []
    for one in identities:
        terms = " ".join(f"{t[0]} {_or_zero(t[1:])}" for t in one.terms.split())
        gap = f"abs({_or_zero(one.total)} - (0 {terms}))"
        rules.append((f"{gap} > {tolerance} * abs({_or_zero(one.base)})", one.message))
    return rules


def statement_rules(kind: str) -> list[Rule]:
    """Rules of a financial statement: required columns, signs, accounting identities."""
    form = STATEMENTS[kind]
    return [
        *mandatory(form.indicators, "{} is null"),
        *non_negative(form.indicators),
        *identity_rules(form.identities),
    ]


def catalogue_rules(indicators: Sequence[Indicator]) -> list[Rule]:
    return [*mandatory(indicators, "{} is mandatory but null"), *non_negative(indicators)]


def quote_rules() -> list[Rule]:
    return catalogue_rules(HISTORICAL_QUOTES)


def fundamental_1_rules() -> list[Rule]:
    return catalogue_rules(FUNDAMENTAL_1)


def fundamental_2_rules() -> list[Rule]:
    return [
        (f"upper(exchange) NOT IN {EXCHANGES}", "invalid_exchange"),
        ("NOT is_listing", "delisted_or_inactive"),
        *catalogue_rules(FUNDAMENTAL_2),
    ]


def fundamental_quarter_rules() -> list[Rule]:
    return [
        *catalogue_rules(FUNDAMENTAL_QUARTER),
        ("market_cap = 0", "Err: Market Cap is zero"),
    ]


def dividend_rules() -> list[Rule]:
    return non_negative(DIVIDEND)


def company_rules(min_market_cap: float = MIN_MARKET_CAP,
                  min_avg_volume: float = MIN_AVG_VOLUME) -> list[Rule]:
    """Rules of the company master over its joined inputs (fun1_*, fun2_* columns)."""

    def carried(prefix: str, label: str) -> Rule:
        text = Computed(f"'[{label}]: ' || {prefix}_unqualified_reason")
        return f"{prefix}_status = '{UNQUALIFIED}'", text

    return [
        ("fun1_ticker IS NULL", "[API Error]: Missing fundamental_1 data"),
        ("fun2_ticker IS NULL", "[API Error]: Missing fundamental_2 data"),
        carried("fun1", "Silver Fun1 Error"),
        carried("fun2", "Silver Fun2 Error"),
        (f"company_type <> '{STANDARD_COMPANY}'",
         "[Gold Rule]: Excluded Financials/Funds (Not a standard Corporate)"),
        (f"market_cap < {min_market_cap}",
         "[Gold Rule]: market_cap < 500B VND (Penny/Illiquid)"),
        (f"avg_volume_3m < {min_avg_volume}",
         "[Gold Rule]: avg_volume_3m < 10k (Dead Stock)"),
    ]


def completeness_rules(flags: Mapping[str, str]) -> list[Rule]:
    """Presence flag -> message, for inputs an outer join did not find."""
    return [(f"{flag} IS NULL", message) for flag, message in flags.items()]


def gap_rule(gap: str, n: int, message: str) -> Rule:
    return f"{gap} IS NULL OR {gap} <> {n}", message


def min_history_rule(count: str, least: int, message: str) -> Rule:
    return f"{count} < {least}", message


def staleness_rule(age: str, most: int, message: str) -> Rule:
    return f"{age} > {most}", message


def component_null_rules(columns: Sequence[str], message: str = "{} is null") -> list[Rule]:
    return null_rules(columns, message)


def null_or_zero_rule(column: str, message: str) -> Rule:
    return f"{column} IS NULL OR {column} = 0", message
