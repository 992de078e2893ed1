"""Cross-sectional ranks, z-scores and their combination."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.operators import clean, combine, quality
from factorloom.operators.ranking import rank_and_score
from factorloom.plans.panel import QUARTER

BY_QUARTER = ("absolute_quarter",)

# Component scores of each pillar (score -> raw measure), in rule order.
COMPONENTS = {
    "profitability": {"z_gpoa": "gpoa", "z_roe": "roe", "z_roa": "roa", "z_cfoa": "cfoa",
                      "z_gmar": "gmar", "z_acc": "acc"},
    "growth": {"z_delta_gpoa": "delta_gpoa", "z_delta_roe": "delta_roe",
               "z_delta_roa": "delta_roa", "z_delta_cfoa": "delta_cfoa",
               "z_delta_gmar": "delta_gmar"},
    "safety": {"z_bab": "bab_score", "z_lev": "lev_score", "z_o": "ohlson_o_score",
               "z_z": "altman_z_score", "z_evol": "evol_score"},
}
PILLAR_SCORES = {"profitability": "qmj_profitability_score", "growth": "qmj_growth_score",
                 "safety": "qmj_safety_score"}
PILLAR_MESSAGES = {"qmj_profitability_score": "Missing Profitability Score",
                   "qmj_growth_score": "Missing Growth Score",
                   "qmj_safety_score": "Missing Safety Score"}


# Digits of summed scores that count for ranking.
SUM_DIGITS = 10


def _sum(columns: Sequence[str]):
    """Sum of scores, NULL when any is missing.

    A cluster adds up means and deviations in no fixed order, so the last bits of a score
    differ between runs.  Rounding lets sums that are equal tie, on every run.
    """
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return F.round(total, SUM_DIGITS)


def score_components(raw: DataFrame, pillar: str) -> DataFrame:
    """Rank each raw measure of a pillar within its quarter and standardise the ranks."""
    scores = COMPONENTS[pillar]
    base = clean.qualified_only(raw).select(*QUARTER, *scores.values())
    rows = rank_and_score(base, BY_QUARTER, scores).drop(*scores.values())
    return quality.apply_rules(rows, quality.component_null_rules(list(scores)))


def pillar_score(components: DataFrame, pillar: str) -> DataFrame:
    """Sum of a pillar's scores, ranked and standardised once more."""
    scores, out = list(COMPONENTS[pillar]), PILLAR_SCORES[pillar]
    rows = clean.qualified_only(components).select(*QUARTER, *scores)
    rows = rows.withColumn("_sum", _sum(scores))
    return rank_and_score(rows, BY_QUARTER, {out: "_sum"}).drop("_sum")


def qmj_final(profitability: DataFrame, growth: DataFrame, safety: DataFrame) -> DataFrame:
    """Quality score from the three pillars; a missing pillar leaves the row unscored."""
    pillars = list(PILLAR_MESSAGES)
    sides = [
        df.select(*[F.col(c).cast("bigint") if c != "ticker" else F.col(c) for c in QUARTER],
                  score)
        for df, score in zip((profitability, growth, safety), pillars)
    ]
    joined = combine.full_outer_chain(sides, QUARTER).withColumn("_sum", _sum(pillars))
    rows = rank_and_score(joined, BY_QUARTER, {"qmj_score": "_sum"}).drop("_sum")
    rules = [(f"{c} IS NULL", m) for c, m in PILLAR_MESSAGES.items()]
    return quality.apply_rules(rows, rules)


def value_momentum_z(value: DataFrame, momentum: DataFrame) -> DataFrame:
    """Value and momentum scores per quarter."""
    sides = [
        clean.qualified_only(df).select(
            *[F.col(c).cast("bigint") if c != "ticker" else F.col(c) for c in QUARTER], raw)
        for df, raw in ((value, "value_raw_score"), (momentum, "momentum_raw_score"))
    ]
    joined = combine.full_outer_chain(sides, QUARTER)
    scores = {"z_value": "value_raw_score", "z_momentum": "momentum_raw_score"}
    rows = rank_and_score(joined, BY_QUARTER, scores)
    return quality.apply_rules(rows, quality.component_null_rules(list(scores)))


def value_momentum_z_live(value: DataFrame, momentum: DataFrame) -> DataFrame:
    """The same over the whole market at once.

    All rows form one group.
    """
    v = clean.qualified_only(value).select("ticker", "value_recent_score")
    m = clean.qualified_only(momentum).select("ticker", "momentum_recent")
    scores = {"z_value_recent": "value_recent_score", "z_momentum_recent": "momentum_recent"}
    rows = rank_and_score(v.join(m, "ticker", "full"), [], scores)
    return quality.apply_rules(rows, quality.component_null_rules(list(scores)))
