"""Operators on small hand-made frames."""

from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factorloom.catalogue import FUNDAMENTAL_1, STATEMENTS
from factorloom.functions import exprs, periods
from factorloom.operators import (
    aggregates,
    clean,
    combine,
    datatests,
    dedup,
    incremental,
    observe,
    quality,
    ranking,
    reshape,
    state,
    topk,
    windows,
)
from factorloom.plans import cleaned
from factorloom.sources import tables


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


# Expressions -------------------------------------------------------------------------------

def test_ratio_modes(spark):
    df = spark.sql("SELECT CAST(1 AS DECIMAL(20,4)) a, CAST(3 AS DECIMAL(20,4)) b,"
                   " CAST(0 AS DECIMAL(20,4)) z")
    got = df.select(exprs.ratio("a", "b"), exprs.ratio("a", "b", "decimal4"),
                    exprs.ratio("a", "z"), exprs.ratio("a", "z", "decimal4")).first()
    assert got[0] == pytest.approx(1 / 3)
    assert str(got[1]) == "0.3333"
    assert got[2] is None and got[3] is None
    with pytest.raises(ValueError):
        exprs.ratio("a", "b", "other")


def test_quantised_ratio_rounds_once(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(20,4)) v, CAST(1000000 AS DECIMAL(20,4)) w"
                   " FROM VALUES (123450), (123449.6), (-123450) AS t(v)")
    got = [str(r[0]) for r in df.select(exprs.ratio("v", "w", "decimal4")).collect()]
    assert got == ["0.1235", "0.1234", "-0.1235"]


def test_quantised_mode_runs_through_the_models(spark, ctx):
    from dataclasses import replace

    from factorloom.plans import factors
    from factorloom.plans.panel import POINT_IN_TIME, TTM_MEASURES

    money = [f"CAST({100 + i} + id AS DECIMAL(20,4)) AS {c}" for i, c in enumerate(
        [*(f"{m}_ttm" for m in TTM_MEASURES), *POINT_IN_TIME])]
    ttm = spark.range(20).selectExpr(
        "'AAA' AS ticker", "CAST(2020 + (id - id % 4) / 4 AS INT) AS year",
        "CAST(id % 4 + 1 AS INT) AS quarter", "8081 + id AS absolute_quarter", *money,
        "2.0D AS risk_free_rate", "100.0D AS cpi_index", "'valid_ttm' AS ttm_status")
    exact = replace(ctx, ratio_mode="decimal4")
    for model in (factors.profitability, factors.growth, factors.altman_z, factors.ohlson_o,
                  factors.value_hist):
        a, b = model(ttm, ctx), model(ttm, exact)
        assert a.where("status = 'qualified'").count() > 0
        assert a.count() == b.count()
    assert dict(factors.profitability(ttm, exact).dtypes)["gpoa"] == "decimal(38,4)"


def test_quantised_ratio_makes_ties(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(20,4)) v, CAST(100000 AS DECIMAL(20,4)) w"
                   " FROM VALUES (10001), (10002), (20000) AS t(v)")
    q = df.select(exprs.ratio("v", "w", "decimal4").alias("q"))
    assert q.distinct().count() == 2


def test_null_rules_of_functions(spark):
    df = spark.sql("SELECT -1D AS neg, 0D AS zero, CAST(NULL AS DOUBLE) AS none")
    got = df.select(exprs.positive_ln("neg"), exprs.positive_ln("zero"),
                    exprs.strict_greatest("neg", "none"),
                    exprs.strict_greatest("neg", "zero")).first()
    assert got[:3] == (None, None, None) and got[3] == 0.0


def test_reason_order_and_separator(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) a, -1 b, 5 c")
    rules = [("a IS NULL", "a is null"), ("b < 0", "b's sign"), ("c < 0", "never")]
    got = quality.apply_rules(df, rules).first()
    assert got.unqualified_reason == "a is null | b's sign" and got.status == "unqualified"
    assert quality.apply_rules(df, rules[2:]).first().status == "qualified"


def test_periods(spark):
    df = spark.sql("SELECT DATE '2024-02-10' AS q1, DATE '2024-05-10' AS q2,"
                   " DATE '2023-11-01' AS start")
    year, quarter = periods.previous_quarter("q1")
    got = df.select(year, quarter, periods.quarters_to_fetch("start", "q2"),
                    periods.years_to_fetch("start", "q2"),
                    periods.trading_days_to_fetch("start", "q2"),
                    periods.trading_days_to_fetch("q2", "q1"),
                    periods.fallback_year("q2")).first()
    # 2024Q1 - 2023Q4 + 2; 2023 - 2023 + 1; int(190 * 250 / 365) + 20
    assert tuple(got) == (2023, 4, 3, 1, 150, None, 2016)


# Cleaning ----------------------------------------------------------------------------------

def test_extract_fields_survives_bad_values(spark):
    df = spark.createDataFrame(
        [(1, '{"marketCap": "x", "sharesOutstanding": 5}'), (2, "{broken"), (3, None)],
        "id int, data string")
    got = {r.id: r for r in clean.extract_fields(df, "data", FUNDAMENTAL_1, ["id"]).collect()}
    assert got[1].market_cap is None and got[1].shares_outstanding == 5.0
    assert got[2].shares_outstanding is None and got[3].market_cap is None


def test_regex_and_normalise(spark):
    df = spark.createDataFrame([(" abc ",), ("AB",), ("ABCD",), (None,)], "ticker string")
    kept = clean.regex_filter(clean.normalize_key(df), "ticker")
    assert rows(kept) == [("ABC",)]


def test_recent_slice_and_empty_source(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01'), (2, TIMESTAMP '2024-01-09'),"
                   " (3, TIMESTAMP '2024-01-10') AS t(id, ts)")
    assert rows(clean.recent_slice(df, "ts"), "id") == [(2,), (3,)]
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    with pytest.raises(Exception, match="empty"):
        clean.recent_slice(stored.where("id > 9"), "ts").collect()


def test_incremental_slice_boundaries(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01'), (2, TIMESTAMP '2024-01-02')"
                   " AS t(id, ts)")
    assert rows(clean.incremental_slice(df, df.where("id = 1"), "ts"), "id") == [(2,)]
    assert clean.incremental_slice(df, df.where("id > 9"), "ts").count() == 2
    assert clean.incremental_slice(df, None, "ts") is df


def test_audit_columns(spark, ctx):
    got = clean.with_audit(spark.range(1), "silver", ctx)
    assert got.columns == ["id", "silver_updated_at", "silver_invocation_id"]
    with pytest.raises(ValueError):
        clean.with_audit(spark.range(1), "bronze", ctx)


# Deduplication and reshaping ----------------------------------------------------------------

def test_dedup_latest_is_stable_under_ties_and_order(spark):
    data = [("a", 1, 10), ("a", 2, 20), ("a", 2, 30), ("b", None, 1), ("b", 1, None)]
    df = spark.createDataFrame(data, "k string, ts int, v int")
    want = [("a", 2, 30), ("b", 1, None)]
    for frame in (df, df.repartition(3), df.orderBy(F.desc("v"))):
        assert rows(dedup.dedup_latest(frame, ["k"], ["ts"])) == want


def test_dedup_first_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("a", "z"), ("b", None)], "k string, name string")
    assert rows(dedup.dedup_first(df, ["k"], ["name"])) == [("a", "z"), ("b", None)]


def test_flatten_reports(spark):
    df = spark.sql("SELECT 'x' AS ticker, array(struct(7 AS id, 'n' AS name, array(struct(2020 AS"
                   " year, 1 AS quarter, 1.5D AS value), struct(2020 AS year, 2 AS quarter,"
                   " 2.5D AS value)) AS values)) AS data")
    assert rows(reshape.flatten_reports(df), "ticker", "indicator_id", "quarter", "value") == [
        ("x", 7, 1, 1.5), ("x", 7, 2, 2.5)]


def test_explode_keeps_empty_lists(spark):
    df = spark.sql("SELECT 1 AS id, array(5) AS data UNION ALL SELECT 2, slice(array(1), 1, 0)")
    assert rows(reshape.explode_records(df)) == [(1, 5), (2, None)]


# Quality -----------------------------------------------------------------------------------

def wide(spark, **values):
    form = STATEMENTS["cash_flow"]
    items = [f"CAST({values.get(i.alias, 'NULL')} AS {i.type}) AS {i.alias}"
             for i in form.indicators]
    return spark.range(1).selectExpr(*items)


def test_identity_tolerance(spark):
    rules = quality.statement_rules("cash_flow")
    base = dict(cfo=100, cfi=0, cff=0, beginning_cash=0)
    near = wide(spark, **base, net_cash_flow=100.9, ending_cash=100.9)
    far = wide(spark, **base, net_cash_flow=101.1, ending_cash=101.1)
    assert quality.apply_rules(near, rules).first().status == "qualified"
    assert quality.apply_rules(far, rules).first().unqualified_reason == (
        "Err: ID 4 (Net CF) != ID 104 + 212 + 311")


def test_several_broken_rules(spark):
    df = wide(spark, cfo=1, net_cash_flow=1, ending_cash=-1)
    assert quality.apply_rules(df, quality.statement_rules("cash_flow")).first()[
        "unqualified_reason"] == ("beginning_cash is null | ending_cash cannot be negative"
                                  " | Err: ID 7 (Ending Cash) != ID 5 + 4 + 6")


# Windows -----------------------------------------------------------------------------------

def series(spark, n=400, entities=3):
    return spark.range(n * entities).selectExpr(
        f"CAST(id % {entities} AS INT) AS k", f"CAST(id DIV {entities} AS INT) AS t",
        "CASE WHEN id % 17 = 0 THEN NULL ELSE 5 + sin(id * 1.3) END AS x",
        "CASE WHEN id % 23 = 0 THEN NULL ELSE 1000 + cos(id * 0.7) * id END AS y")


@pytest.mark.parametrize("n", [40, 100])
def test_rolling_moments_are_exact_after_any_history(spark, n):
    """A volatile stretch, a change of scale by a million, then a constant one; NULLs between."""
    import numpy as np
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1e6, 350), rng.normal(5, 1, 350), np.full(250, 0.001)])
    y = np.concatenate([rng.normal(0, 1, 700), rng.normal(0, 1, 250)]) + x * 1e-3
    data = [(0, i, None if i % 13 == 0 else float(a), float(b))
            for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "k int, t int, x double, y double")
    out = windows.rolling_corr(windows.rolling_stddev(df, ["k"], "t", {"s": "x"}, n, {"m": "s"}),
                               ["k"], "t", "x", "y", n, "c", "m2").orderBy("t").collect()
    for i, r in enumerate(out):
        window = [(a, b) for _, _, a, b in data[max(0, i - n + 1):i + 1] if a is not None]
        assert r.m == r.m2 == len(window)
        if len(window) < 2:
            assert r.s is None and r.c is None
            continue
        a, b = (np.array(v) for v in zip(*window))
        if a.min() == a.max():
            assert r.s == 0 and r.c is None
        else:
            assert abs(r.s / a.std(ddof=1) - 1) < 1e-9
            assert abs(r.c - np.corrcoef(a, b)[0, 1]) < 1e-9


def test_rolling_matches_built_in(spark):
    df = series(spark)
    frame = W.partitionBy("k").orderBy("t").rowsBetween(-49, 0)
    slow = df.select("k", "t", F.stddev_samp("x").over(frame).alias("s"),
                     F.corr("x", "y").over(frame).alias("c"), F.count("x").over(frame).alias("n"))
    fast = windows.rolling_corr(
        windows.rolling_stddev(df, ["k"], "t", {"s": "x"}, 50, {"n": "s"}),
        ["k"], "t", "x", "y", 50, "c")
    both = slow.alias("a").join(fast.alias("b"), ["k", "t"])
    for c in ("s", "c"):
        a, b = F.col(f"a.{c}"), F.col(f"b.{c}")
        off = both.where(~((F.abs(a - b) < 1e-9) | (a.isNull() & b.isNull())))
        assert off.count() == 0, c
    assert both.where("a.n <> b.n").count() == 0


def test_rolling_of_constant_series(spark):
    df = spark.range(30).selectExpr("1 AS k", "id AS t", "0.1D AS x", "id * 1D AS y")
    out = windows.rolling_corr(windows.rolling_stddev(df, ["k"], "t", {"s": "x"}, 5),
                               ["k"], "t", "x", "y", 5, "c")
    assert out.where("c IS NOT NULL OR s > 0").count() == 0


def test_gap_lag_sees_missing_period(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 4, 4.0)],
                               "k string, q int, v double")
    got = rows(windows.gap_lag(df, ["k"], "q", {"past": "v"}, 2), "q", "past", "gap")
    assert got == [(1, None, None), (2, None, None), (4, 1.0, 3)]


# Ranking -----------------------------------------------------------------------------------

def scored(spark):
    return spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'g' || id % 7 END AS g",
        "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 2 = 0 THEN 1.0 ELSE (id * 37) % 101 END AS v")


def window_ranks(df, columns, descending=False, nullable=True):
    """The ranks by plain windows, a whole group in each."""
    for out, c in columns.items():
        order = F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()
        rank = F.rank().over(W.partitionBy("g").orderBy(order)).cast("bigint")
        df = df.withColumn(out, F.when(F.col(c).isNotNull(), rank) if nullable else rank)
    return df


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("nullable", [False, True])
def test_rank_equals_window(spark, descending, nullable):
    df = scored(spark).withColumns({"w": F.col("id") * 7 % 2999, "none": F.lit(None).cast("int")})
    outs = {"r": "v", "s": "w", "t": "none"}
    got = ranking.xs_rank(df, ["g"], outs, descending, nullable)
    assert got.columns == [*df.columns, *outs]
    assert rows(got, "id", *outs) == rows(
        window_ranks(df, outs, descending, nullable), "id", *outs)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert all("_bucket" in line or "_column" in line for line in plan.splitlines()
               if "Window [" in line)


def test_rank_of_null_groups_repeats_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1.5), (None, 1.5), ("a", 2.0), ("a", None), ("a", 2.0)],
                               "g string, v double")
    got = ranking.rank_and_score(ranking.xs_rank(df, ["g"], {"r": "v"}), ["g"], {"z": "v"})
    assert rows(got, "g", "v", "r", "z") == rows(spark.createDataFrame(
        [(None, 1.5, 1, None), (None, 1.5, 1, None), ("a", 2.0, 1, None), ("a", None, None, None),
         ("a", 2.0, 1, None)], "g string, v double, r bigint, z double"), "g", "v", "r", "z")
    assert ranking.xs_rank(df.limit(0), ["g"], {"r": "v"}).collect() == []


def test_rank_and_score_equals_windows(spark):
    df = scored(spark)
    by = W.partitionBy("g")
    want = window_ranks(df, {"r": "v"}).withColumn(
        "z", (F.col("r") - F.avg("r").over(by)) / F.stddev_samp("r").over(by))
    got = ranking.rank_and_score(df, ["g"], {"z": "v"})
    assert rows(got.select("id", F.round("z", 9))) == rows(want.select("id", F.round("z", 9)))
    every = ranking.rank_and_score(df, [], {"z": "v"}).agg(
        F.round(F.avg("z"), 9), F.round(F.stddev_samp("z"), 9)).first()
    assert tuple(every) == (0.0, 1.0)


def test_zscore_of_constant_group_is_null(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 5.0)], "g int, v double")
    assert rows(ranking.zscore(df, ["g"], {"z": "v"}), "z") == [(None,)] * 3


def test_row_numbers_of_hot_group(spark):
    df = spark.range(1000).selectExpr("id", "id % 2 AS g")
    got = ranking.row_numbers(df, ["g"], [F.col("id").desc()], "n")
    assert got.where("n <> 500 - id DIV 2").count() == 0


# Combination -------------------------------------------------------------------------------

def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows(combine.orphans(child, parent, "k")) == [(2,)]


def test_benchmark_with_repeated_days_does_not_multiply(spark):
    s = spark.createDataFrame([("a", 1), ("b", 1)], "ticker string, date int")
    b = spark.createDataFrame([(1, 5.0), (1, 5.0)], "date int, ret double")
    assert rows(combine.with_benchmark(s, b), "ticker", "mkt_ret") == [("a", 5.0), ("b", 5.0)]


def test_rate_bps(spark):
    df = spark.range(3).selectExpr("CASE WHEN id = 0 THEN 'bad' END AS s")
    assert datatests.invalid_rate(df, "s", "bad").first()[0] == 3333
    assert aggregates.rate_bps(df.limit(0), F.lit(True)).first()[0] is None


# History and state -------------------------------------------------------------------------

def test_scd2_cycle(spark):
    def current(*data):
        return spark.createDataFrame(list(data), "k int, v string")

    t = [utc(2024, 1, d) for d in range(1, 6)]
    for mode in ("invalidate", "new_record"):
        h = incremental.scd2(None, current((1, "a"), (2, "b"), (3, None)), ["k"], ["v"], t[0], mode)
        same = incremental.scd2(h, current((1, "a"), (2, "b"), (3, None)), ["k"], ["v"], t[1], mode)
        assert rows(same) == rows(h)
        h = incremental.scd2(h, current((1, None), (3, None)), ["k"], ["v"], t[1], mode)
        assert h.where("k = 1").count() == 2
        gone = h.where("k = 2").orderBy("valid_from").collect()
        assert gone[0].valid_to is not None
        assert len(gone) == (2 if mode == "new_record" else 1)
        h = incremental.scd2(h, current((1, None), (2, "b"), (3, None)), ["k"], ["v"], t[2], mode)
        back = h.where("k = 2 AND valid_to IS NULL").collect()
        assert len(back) == 1 and back[0].is_deleted is False
    with pytest.raises(ValueError):
        incremental.scd2(h, current((1, "a")), ["k"], ["v"], t[3], "drop")


def test_append_then_merge_equals_rebuild(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ts int")
    new = spark.createDataFrame([(2, "c", 2), (3, "d", 2)], "k int, v string, ts int")
    merged = incremental.merge_latest(old, new, ["k"])
    assert rows(merged) == rows(dedup.dedup_latest(old.unionByName(new), ["k"], ["ts"]))


def test_watermark_resets_on_dividend_change_alone(spark):
    start = utc(2024, 1, 1)
    held = spark.createDataFrame([("a", "q", "active", start), ("z", "other", "active", start)],
                                 "ticker string, data_type string, ticker_status string,"
                                 " updated_at timestamp")
    ref = spark.createDataFrame([("a",)], "ticker string")
    got = state.sync_watermark(held, ref, "q", date(2016, 1, 1), ref)
    assert rows(got.selectExpr("ticker", "ticker_status", "year(updated_at)")) == [
        ("a", "active", 2016), ("z", "active", 2024)]


def test_reconcile_without_data_resets(spark):
    held = spark.createDataFrame([("a", "q", "active", utc(2024, 1, 1))],
                                 "ticker string, data_type string, ticker_status string,"
                                 " updated_at timestamp")
    data = spark.createDataFrame([], "ticker string, year int, data_type string,"
                                     " bronze_ingested_time timestamp")
    assert state.reconcile_watermark(held, data, "q", date(2024, 1, 1)).count() == 0


def test_record_state_rejects_repeats(spark, ctx):
    held = spark.createDataFrame([("b", "q", "a", utc(2024, 1, 1))],
                                 "batch_id string, data_type string, ticker string,"
                                 " created_time timestamp")
    keys = spark.createDataFrame([("a",)], "ticker string")
    with pytest.raises(ValueError):
        state.record_state(held, keys, "q", "b2", ctx)
    assert state.record_state(held, keys, "r", "b2", ctx).count() == 2


# Sources -----------------------------------------------------------------------------------

def test_freshness_levels(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01' AS bronze_ingested_time")
    limits = {"a": (1, 5), "b": (20, 30), "c": (1, 100), "d": (1, 2)}
    got = tables.freshness({"a": df, "b": df, "c": df, "d": df.limit(0)}, utc(2024, 1, 11), limits)
    assert rows(got, "table_name", "status") == [
        ("a", "error"), ("b", "pass"), ("c", "warn"), ("d", "error")]


# Reports -----------------------------------------------------------------------------------

def test_screen_modes(spark):
    obt = spark.createDataFrame(
        [("AAA", 5, 1, 0.1, 0.3), ("AAB", 5, 2, 0.9, None), ("ZZZ", 5, 3, 0.5, 0.9),
         ("OLD", 4, 1, 0.0, 0.0)],
        "ticker string, absolute_quarter int, qmj_rank int, z_value_recent double,"
        " z_momentum_recent double")
    top = [r.ticker for r in topk.screen(obt, top_n=2).collect()]
    assert top == ["AAA", "AAB"]
    assert [r.ticker for r in topk.screen(obt, search=" aa ", criterion="value").collect()] == [
        "AAB", "AAA"]
    assert [r.ticker for r in topk.screen(obt, criterion="momentum").collect()] == [
        "ZZZ", "AAA", "AAB"]


def test_anomaly_rules(spark):
    data = [("m", date(2024, 1, d), v) for d, v in
            enumerate([10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 99.0], 1)]
    df = spark.createDataFrame(data, "metric_name string, d date, metric_value double").selectExpr(
        "metric_name", "'t' AS full_table_name", "'c' AS column_name",
        "CAST(d AS TIMESTAMP) AS bucket_start", "CAST(d AS TIMESTAMP) AS bucket_end",
        "metric_value", "CAST(d AS TIMESTAMP) AS updated_at")
    got = {r.bucket_end.day: r for r in
           observe.metrics_anomaly_score(df, utc(2024, 1, 12), days=30).collect()}
    assert got[1].anomaly_score is None and got[2].anomaly_score == 0.0
    assert got[11].is_anomaly is True and got[2].is_anomaly is False


def test_company_keys_stay_apart_and_well_formed(spark):
    from suite import inputs
    from suite.inputs_sql import ticker
    import duckdb
    keys = [0, 1, 46_655, 46_656, 46_657, 1_700_000, 1_700_001, 2_000_000_000]
    df = spark.createDataFrame([(k,) for k in keys], "s_suppkey long").select(
        inputs.ticker_of("s_suppkey").alias("ticker"), F.lit("CT").alias("company_type"),
        *[F.lit("n").alias(c) for c in ("company_name", "industry_group", "sector_detail")])
    mine = [r.ticker for r in df.collect()]
    assert len(set(mine)) == len(keys)
    assert mine == [duckdb.sql(f"SELECT {ticker(str(k))}").fetchall()[0][0] for k in keys]
    assert cleaned.companies(df, inputs.KEY_PATTERN).count() == len(keys)
    assert cleaned.companies(df).count() == 0


def test_rolling_moments_read_each_row_once(spark):
    rows = spark.createDataFrame([("a", t, float(t % 5), 2.0) for t in range(40)]
                                 + [("b", 1, None, 1.0), (None, 1, 3.0, 1.0)],
                                 "k string, t int, x double, y double")
    out = windows.rolling_corr(windows.rolling_stddev(rows, ["k"], "t", {"s": "x"}, 30,
                                                      {"m": "s"}),
                               ["k"], "t", "x", "y", 20, "rho", "c")
    # a window per power of two would cost a row more than the adding up
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    found = {(r["k"], r["t"]): r for r in out.collect()}
    assert len(found) == 42
    assert (found["a", 39]["m"], found["a", 39]["c"], found["a", 39]["rho"]) == (30, 20, None)
    assert abs(found["a", 39]["s"] ** 2 - 60 / 29) < 1e-12
    assert (found["b", 1]["m"], found["b", 1]["c"], found["b", 1]["s"]) == (0, 0, None)
    assert (found[None, 1]["m"], found[None, 1]["s"]) == (1, None)


def test_rolling_moments_take_many_entities_at_once(spark):
    """Entities that end inside, at the end of, or batches after the one they begin in."""
    sizes = {"a": 3, "b": 1, "c": 8, "d": 2, None: 4, "e": 1}
    rows = spark.createDataFrame(
        [(k, t, None if t == 2 else float(t * t % 7), t) for k, n in sizes.items()
         for t in range(n)], "k string, t int, x double, y int")
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(conf)
    try:
        for size in ("1", "3", "4", "100"):
            spark.conf.set(conf, size)
            out = windows.rolling_corr(
                windows.rolling_stddev(rows, ["k"], "t", {"s": "x"}, 3, {"m": "s"}),
                ["k"], "t", "x", "y", 4, "rho", "c")
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "MapInArrow" in plan and "FlatMapGroups" not in plan
            by = W.partitionBy("k").orderBy("t")
            near, far = by.rowsBetween(-2, 0), by.rowsBetween(-3, 0)
            plain = rows.select("k", "t", F.stddev_samp("x").over(near).alias("s"),
                                F.count("x").over(near).alias("m"),
                                F.corr("x", "y").over(far).alias("rho"),
                                F.count("x").over(far).alias("c"))
            wanted = {(r.k, r.t): r for r in plain.collect()}
            found = {(r.k, r.t): r for r in out.collect()}
            assert found.keys() == wanted.keys()
            for key, r in found.items():
                w = wanted[key]
                assert (r.m, r.c) == (w.m, w.c)
                assert (r.s is None) == (w.s is None) and abs((r.s or 0) - (w.s or 0)) < 1e-9
                assert r.rho is None or abs(r.rho - w.rho) < 1e-9
    finally:
        spark.conf.set(conf, held)


def test_statement_values_reach_their_row_unwidened(spark, ctx):
    """No wide row is made before the shuffle that brings a quarter's values together."""
    at = datetime(2024, 5, 1, tzinfo=timezone.utc)
    rows = spark.createDataFrame(
        [("AAA", 2024, 1, "balance_sheet_quarter", i, float(i), at) for i in (2, 4, 101)]
        + [(None, 2024, 1, "balance_sheet_quarter", 2, 5.0, at)],
        "ticker string, year int, quarter int, data_type string, indicator_id int, value double,"
        " bronze_ingested_time timestamp")
    wide = cleaned.statement_wide(rows, "balance_sheet", ctx)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    last = plan[:plan.index(exchanges[0])]
    # partial and final sums stand together behind the last shuffle
    assert "partial_max" in last and len(exchanges) == 2
    found = {r.ticker: r for r in wide.collect()}
    assert len(found) == 2 and found[None].total_assets == 5
    assert (found["AAA"].total_assets, found["AAA"].total_capital) == (2, 4)
