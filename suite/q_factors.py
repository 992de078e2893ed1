"""Factor models, row rules and the serving table."""

from __future__ import annotations

from pyspark.sql import functions as F

from factorloom.functions.exprs import QUALIFIED
from factorloom.operators import topk
from factorloom.plans import serving
from factorloom.plans.panel import POINT_IN_TIME, QUARTER, TTM_MEASURES
from suite import inputs_sql as x
from suite.models import Models, models
from suite.registry import query, r, rounded, rs

KEY = "ticker, year, quarter, CAST(absolute_quarter AS BIGINT) AS absolute_quarter"
BIGKEY = ("ticker, CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter,"
          " CAST(absolute_quarter AS BIGINT) AS absolute_quarter")
JUDGED = "status, unqualified_reason"


def _score_query(name: str, table: str, columns: tuple[str, ...], build, key: str = KEY,
                 digits: int = 6) -> None:
    oracle = f"SELECT {key}, {rs(*columns, digits=digits)}, {JUDGED} FROM {table}"

    def run(spark, sf_dir):
        df = build(models(spark, sf_dir))
        return rounded(df.select(*QUARTER, *columns, "status", "unqualified_reason"), *columns,
                       digits=digits)

    query(name, oracle)(run)


_PANEL = ("gross_revenue", "net_income_parent", "total_assets", "minority_interest", "cfo",
          "capex", "market_cap", "preferred_stock")


@query("financial_panel", f"SELECT ticker, year, quarter, {rs(*_PANEL, digits=4)}, {JUDGED}"
                          " FROM x_panel")
def financial_panel(spark, sf_dir):
    df = models(spark, sf_dir).panel()
    return rounded(df.select("ticker", "year", "quarter", *_PANEL, "status",
                             "unqualified_reason"), *_PANEL, digits=4)


_SUMS = tuple(f"{m}_ttm" for m in TTM_MEASURES)


@query("ttm_metrics", f"""SELECT {KEY}, {rs(*_SUMS, *POINT_IN_TIME, digits=4)},
    {rs('risk_free_rate', 'cpi_index')}, CAST(quarter_gap AS BIGINT) AS quarter_gap, ttm_status
    FROM x_ttm""")
def ttm_metrics(spark, sf_dir):
    df = rounded(models(spark, sf_dir).ttm(), *_SUMS, *POINT_IN_TIME, digits=4)
    return rounded(df, "risk_free_rate", "cpi_index")


_score_query("profitability", "x_prof", ("gpoa", "roe", "roa", "gmar", "cfoa", "acc"),
             Models.profitability)
_score_query("growth", "x_grow", ("delta_gpoa", "delta_roe", "delta_roa", "delta_cfoa",
                                  "delta_gmar"), Models.growth)
_score_query("altman_z", "x_alt", ("x1_wc_at", "x2_re_at", "x3_ebit_at", "x4_me_at",
                                   "x5_sale_at", "altman_z_score"), Models.altman)
_score_query("ohlson_o", "x_ohl", ("log_size", "tlta", "wcta", "clca", "oeneg", "nita", "futl",
                                   "intwo", "chin", "ohlson_o_score"), Models.ohlson)
_score_query("beta_bab", "x_bab", ("vol_stock_1y", "vol_mkt_1y", "stock_ret_3d", "mkt_ret_3d",
                                   "rho_4y", "count_corr_days", "beta_ts", "beta_final",
                                   "bab_score"), Models.beta_bab)
_score_query("safety", "x_safe", ("bab_score", "lev_score", "ohlson_o_score", "altman_z_score",
                                  "evol_score"), Models.safety, BIGKEY)
_score_query("value_hist", "(SELECT *, be_lag AS book_equity_6m_lag FROM x_val)",
             ("market_cap", "book_equity_6m_lag", "value_raw_score"), Models.value_hist,
             digits=4)
_score_query("momentum_hist", "x_mom", ("gap_12m", "price_t_1", "price_t_12",
                                        "momentum_raw_score"), Models.momentum_hist)
_score_query("qmj_final", "x_qmj", ("qmj_profitability_score", "qmj_growth_score",
                                    "qmj_safety_score", "qmj_score"), Models.qmj, BIGKEY)
_score_query("value_momentum_z", "x_vm", ("value_raw_score", "momentum_raw_score", "z_value",
                                          "z_momentum"), Models.value_momentum, BIGKEY)

_VOL = ("stock_ret", "mkt_ret", "vol_stock_1y", "vol_mkt_1y")


@query("beta_vol", f"SELECT ticker, date, {rs(*_VOL)}, count_trading_days, {JUDGED} FROM x_vol")
def beta_vol(spark, sf_dir):
    df = models(spark, sf_dir).beta_vol()
    return rounded(df.select("ticker", "date", *_VOL, "count_trading_days", "status",
                             "unqualified_reason"), *_VOL)


@query("value_recent", f"""SELECT ticker, CAST(days_since_update AS INT) AS days_since_update,
    report_year, report_quarter, CAST(latest_absolute_quarter AS BIGINT)
    AS latest_absolute_quarter, CAST(current_absolute_quarter AS BIGINT)
    AS current_absolute_quarter, CAST(quarters_delayed AS BIGINT) AS quarters_delayed,
    {rs('market_cap', 'latest_book_equity', digits=2)}, {rs('value_recent_score', digits=12)},
    {JUDGED} FROM x_valr""")
def value_recent(spark, sf_dir):
    df = models(spark, sf_dir).value_recent().drop("last_market_cap_update")
    df = rounded(df, "market_cap", "latest_book_equity", digits=2)
    return rounded(df, "value_recent_score", digits=12)


@query("momentum_recent", f"""SELECT ticker, date AS last_trade_date,
    CAST(days_since_last_trade AS INT) AS days_since_last_trade, date_t_21, date_t_252,
    {rs('price_t_21', 'price_t_252', 'momentum_recent')}, {JUDGED} FROM x_momr""")
def momentum_recent(spark, sf_dir):
    return rounded(models(spark, sf_dir).momentum_recent(), "price_t_21", "price_t_252",
                   "momentum_recent")


@query("value_momentum_z_live", f"""SELECT ticker, {rs('value_recent_score', digits=12)},
    {rs('momentum_recent', 'z_value_recent', 'z_momentum_recent')}, {JUDGED} FROM x_vml""")
def value_momentum_z_live(spark, sf_dir):
    df = rounded(models(spark, sf_dir).value_momentum_live(), "momentum_recent",
                 "z_value_recent", "z_momentum_recent")
    return rounded(df, "value_recent_score", digits=12)


def _long_scores(short: str) -> str:
    zs = x.PILLARS[short][1]
    return " UNION ALL ".join(
        f"SELECT ticker, CAST(absolute_quarter AS BIGINT) AS absolute_quarter, '{z}' AS score,"
        f" round({z}, 6) + 0.0 AS z, status FROM x_sc_{short}" for z in zs)


@query("score_components", " UNION ALL ".join(_long_scores(s) for s in x.PILLARS))
def score_components(spark, sf_dir):
    chain = models(spark, sf_dir)
    parts = None
    for pillar in ("profitability", "growth", "safety"):
        df = chain.components(pillar)
        zs = [c for c in df.columns if c.startswith("z_")]
        pairs = F.explode(F.array(*[
            F.struct(F.lit(z).alias("score"), r(F.col(z)).alias("z")) for z in zs]))
        rows = df.select("ticker", F.col("absolute_quarter").cast("bigint")
                         .alias("absolute_quarter"), "status", pairs.alias("_p"))
        rows = rows.select("ticker", "absolute_quarter", "status", "_p.*")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query("pillar_score", " UNION ALL ".join(
    f"SELECT ticker, CAST(absolute_quarter AS BIGINT) AS absolute_quarter, '{out}' AS pillar,"
    f" round({out}, 6) + 0.0 AS score FROM x_pl_{s}_z" for s, (_, _, out) in x.PILLARS.items()))
def pillar_score(spark, sf_dir):
    chain = models(spark, sf_dir)
    parts = None
    for pillar in ("profitability", "growth", "safety"):
        df = chain.pillar(pillar)
        out = f"qmj_{pillar}_score"
        rows = df.select("ticker", F.col("absolute_quarter").cast("bigint")
                         .alias("absolute_quarter"), F.lit(out).alias("pillar"),
                         r(F.col(out)).alias("score"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


_DIM = ("ticker, company_name, industry_group, sector_detail, company_type, exchange,"
        " is_listing, status, gold_unqualified_reason")
_DIM_NUM = ("market_cap", "avg_volume_3m", "shares_outstanding", "floating_shares",
            "insider_ownership")


@query("dim_company", f"SELECT {_DIM}, {rs(*_DIM_NUM, digits=2)} FROM x_dim")
def dim_company(spark, sf_dir):
    df = models(spark, sf_dir).dim_company()
    return rounded(df.select(*_DIM.split(", "), *_DIM_NUM), *_DIM_NUM, digits=2)


_OBT_TEXT = ("ticker", "company_name", "exchange", "sector_detail", "industry_group")
_OBT_MONEY = ("current_market_cap", "avg_volume_3m", "current_shares_outstanding",
              "quarter_market_cap", "quarter_shares_outstanding")
_OBT_SCORES = tuple(serving.ROUNDED)
OBT_SQL = f"""SELECT {', '.join(_OBT_TEXT)}, CAST(year AS BIGINT) AS year,
    CAST(quarter AS BIGINT) AS quarter, CAST(absolute_quarter AS BIGINT) AS absolute_quarter,
    {rs(*_OBT_MONEY, digits=2)}, qmj_rank, {rs(*_OBT_SCORES, digits=3)} FROM x_obt"""


def obt_rows(spark, sf_dir):
    df = models(spark, sf_dir).obt()
    return rounded(rounded(df, *_OBT_MONEY, digits=2), *_OBT_SCORES, digits=3)


query("obt_web", OBT_SQL)(obt_rows)


@query("obt_assemble", f"""SELECT absolute_quarter, count(*) AS n_rows, max(qmj_rank) AS max_rank,
    count(z_value_historical) AS n_history, count(z_value_recent) AS n_recent,
    count(quarter_market_cap) AS n_market FROM ({OBT_SQL}) GROUP BY absolute_quarter""")
def obt_assemble(spark, sf_dir):
    return models(spark, sf_dir).obt().groupBy("absolute_quarter").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("qmj_rank").alias("max_rank"),
        F.count("z_value_historical").alias("n_history"),
        F.count("z_value_recent").alias("n_recent"),
        F.count("quarter_market_cap").alias("n_market"))


@query("screener_topn", f"""SELECT ticker, company_name, absolute_quarter, qmj_rank, qmj_score,
    z_value_recent FROM ({OBT_SQL}) WHERE absolute_quarter = (SELECT max(absolute_quarter)
    FROM x_obt) AND qmj_rank <= 30""")
def screener_topn(spark, sf_dir):
    screened = topk.screen(obt_rows(spark, sf_dir), top_n=30, criterion="value")
    return screened.select("ticker", "company_name", "absolute_quarter", "qmj_rank",
                           "qmj_score", "z_value_recent")


def safest(spark, sf_dir, top_n: int = 10):
    """The flagship question: the soundest companies of each quarter by solvency score."""
    from factorloom.operators.ranking import xs_rank

    scored = models(spark, sf_dir).altman().where(F.col("status") == QUALIFIED)
    ranked = xs_rank(scored, ["absolute_quarter"], {"safety_rank": "altman_z_score"},
                     descending=True)
    return ranked.where(F.col("safety_rank") <= top_n).select(
        "ticker", "absolute_quarter", r(F.col("altman_z_score")).alias("altman_z_score"),
        "safety_rank")


query("safest_companies", """
SELECT * FROM (SELECT ticker, CAST(absolute_quarter AS BIGINT) AS absolute_quarter,
    round(altman_z_score, 6) + 0.0 AS altman_z_score, rank() OVER (PARTITION BY absolute_quarter
    ORDER BY altman_z_score DESC NULLS LAST) AS safety_rank
    FROM x_alt WHERE status = 'qualified') WHERE safety_rank <= 10""")(safest)
