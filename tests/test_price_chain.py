"""Daily prices and the momentum models on a small market of their own rows."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from factorloom.plans import factors
from factorloom.session import shared_dir
from suite import inputs
from suite.inputs import CTX
from suite.models import Models

DAYS = 432


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Three companies of two nations, one of them twice; days without lines, lines without values."""
    folder = str(tmp_path_factory.mktemp("market"))
    first = datetime(2000, 9, 1)
    lines = []
    for i in range(DAYS):
        day = first + timedelta(days=i)
        for key in (1, 2, 3):
            if i % (key + 1) == 0:
                price = None if (i + key) % 50 == 0 else 100.0 * key + i
                lines.append((key, float(1 + i % 3), price, day))
    lines += [(None, 2.0, 70.0, first), (9, 2.0, 90.0, first), (1, None, None, first)]
    spark.createDataFrame(
        lines, "l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp"
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(
        [(1, 5), (2, 5), (3, 6), (3, 6), (4, None)], "s_suppkey long, s_nationkey long"
    ).write.parquet(f"{folder}/supplier.parquet")
    return folder


def _steps(spark):
    root = shared_dir(spark).removeprefix("file:")
    return {d for d in os.listdir(root) if d.startswith(("quotes-", "company-days-"))}


def _rows(df):
    return sorted(map(str, df.collect()))


def test_price_days_are_read_from_the_tables_alone(spark, tables):
    before = _steps(spark)
    days = inputs.price_days(spark, tables)
    assert {f.rsplit("/", 2)[-2] for f in days.inputFiles()} == {
        "lineitem.parquet", "supplier.parquet"}
    got = {}
    for r in days.where("ticker <> 'VNINDEX'").collect():
        got.setdefault((r.ticker, str(r.date)), []).append(r)
    assert _steps(spark) == before

    own, nation, home = {}, {}, {1: [5], 2: [5], 3: [6, 6]}
    for r in spark.read.parquet(f"{tables}/lineitem.parquet").collect():
        day = str(r.l_shipdate.date())
        for table, keys in ((own, [r.l_suppkey]), (nation, home.get(r.l_suppkey, []))):
            for key in keys:
                sums = table.setdefault((key, day), [None, None])
                for i, x in enumerate((r.l_extendedprice, r.l_quantity)):
                    if x is not None:
                        sums[i] = (sums[i] or 0) + x
    want = {}
    for (key, at) in ((k, n) for k in home for n in home[k]):
        for (where, day), whole in nation.items():
            if where == at:
                ext, qty = (a if a is not None else b for a, b in zip(
                    own.get((key, day), [None, None]), whole))
                close = None if None in (ext, qty) else int(ext * 100 / qty) / 100
                want.setdefault((f"00000{key}", day), []).append((close, qty))
    assert {k: [(None if r.price_close is None else float(r.price_close), r.total_volume)
                for r in v] for k, v in got.items()} == want


def test_a_single_reader_of_quotes_stores_none(spark, tables):
    held, before = Models(spark, tables), _steps(spark)
    recent = held.momentum_recent()
    assert _steps(spark) == before
    hist = held.momentum_hist()
    assert len(_steps(spark) - before) == 1
    quotes = held.quotes()
    assert len(_steps(spark) - before) == 1
    assert hist.where("momentum_raw_score IS NOT NULL").count() > 0
    assert recent.where(F.col("status") == "qualified").count() > 0
    assert _rows(hist) == _rows(factors.momentum_hist(quotes, CTX))
    assert _rows(recent) == _rows(factors.momentum_recent(quotes, CTX))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _by_ticker(df):
    return _plan(df).count("Exchange hashpartitioning(ticker")


@pytest.mark.parametrize("most", [1 << 18, 1])
def test_company_days_move_to_their_ticker_once(spark, tables, monkeypatch, most):
    monkeypatch.setattr(inputs, "BROADCAST_ROWS", most)
    days = inputs.price_days(spark, tables)
    assert _by_ticker(days) == 1
    if most > 1:  # what moves are the rows before a company has days
        above = _plan(days).split("Exchange hashpartitioning(ticker")[0]
        assert "BroadcastHashJoin [s_nationkey" in above
    monkeypatch.undo()
    assert _rows(days) == _rows(inputs.price_days(spark, tables))


def test_many_days_are_dealt_over_all_partitions(spark, tables, monkeypatch):
    assert "REPARTITION_BY_COL" in _plan(inputs.price_days(spark, tables))
    monkeypatch.setattr(inputs, "TASK_ROWS", 10)
    days = inputs.price_days(spark, tables)
    assert "REPARTITION_BY_NUM" in _plan(days)
    vol = factors.beta_vol(Models(spark, tables).quotes_for_one(), CTX)
    assert _by_ticker(vol) == 1


def test_beta_vol_takes_quotes_where_they_are(spark, tables):
    held, before = Models(spark, tables), _steps(spark)
    vol = held.beta_vol()
    assert _steps(spark) == before
    assert _by_ticker(vol) == 1
    assert _rows(vol) == _rows(factors.beta_vol(held.quotes(), CTX))


def test_beta_moves_what_it_uses(spark, tables):
    last = _plan(factors.beta_bab(Models(spark, tables).beta_vol())).split("moments(")[1]
    assert "vol_stock_1y" in last.split(")")[0]
    assert "count_trading_days" not in last.split(")")[0]
