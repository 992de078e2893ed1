"""The ingest run: state, watermarks, requests, loads; once, also after a crash."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from factorloom import RunContext
from factorloom.plans import landing, runs
from factorloom.sources.store import Warehouse

CTX = RunContext(run_id="r1", started_at=datetime(2024, 5, 10, tzinfo=timezone.utc),
                 as_of=date(2024, 5, 10))
FEED = landing.FEEDS["dividend_year"]
DATA = "array<struct<year:int,cashDividend:double>>"


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "ticker string")


def fetch(*failing, seen=None):
    """Two yearly dividends for every key but those that fail."""
    def answer(batch):
        if seen is not None:
            seen.extend(r.ticker for r in batch.select("ticker").collect())
        payload = F.from_json(F.lit('[{"year": 2022, "cashDividend": 1}, {"year": 2023,'
                                    ' "cashDividend": 2}]'), DATA)
        return batch.withColumn("data", payload).withColumn(
            "ok", ~F.col("ticker").isin(list(failing)) if failing else F.lit(True))
    return answer


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"))


def held(store, name, *columns):
    return sorted((tuple(r) for r in store.read(name).select(*columns).collect()), key=repr)


def test_run_lands_each_key_once(spark, store, tmp_path):
    asked: list[str] = []
    place = str(tmp_path / "feeds")
    got = landing.land(store, FEED, keys(spark, "A", "B", "C"), fetch("B", "C", seen=asked), CTX,
                       place, fetch("C")).collect()
    assert [tuple(r)[2:] for r in got] == [(3, 2, 1, 1)]
    assert sorted(asked) == ["A", "B", "C"]
    assert held(store, FEED.table, "ticker", "year") == [
        ("A", 2022), ("A", 2023), ("B", 2022), ("B", 2023)]
    assert held(store, "ingest_state", "ticker", "batch_id") == [("A", "r1"), ("B", "r1")]
    marks = {r.ticker: (r.ticker_status, r.updated_at.date())
             for r in store.read("ingest_watermark").collect()}
    assert marks["A"] == ("active", date(2024, 5, 10))
    assert marks["C"] == ("active", CTX.fallback_date)
    # the run again does nothing; the next one within a day asks for what is missing
    landing.land(store, FEED, keys(spark, "A", "B", "C"), fetch(seen=asked), CTX, place)
    assert len(asked) == 3
    later = replace(CTX, run_id="r2", started_at=CTX.started_at + timedelta(hours=2))
    landing.land(store, FEED, keys(spark, "A", "B", "C", "D"), fetch(seen=asked), later, place)
    assert sorted(asked[3:]) == ["C", "D"]
    assert store.read(FEED.table).count() == 8
    # a day on all are asked for again; a key that has gone is not
    third = replace(CTX, run_id="r3", started_at=CTX.started_at + timedelta(days=2),
                    as_of=date(2024, 5, 12))
    landing.land(store, FEED, keys(spark, "A", "C", "D"), fetch(seen=asked), third, place)
    assert sorted(asked[5:]) == ["A", "C", "D"]
    status = {r.ticker: r.ticker_status for r in store.read("ingest_watermark").collect()}
    assert status["B"] == "inactive"


STEPS = ("publish", "first load", "append", "state", "watermark", "summary")


@pytest.mark.parametrize("step", STEPS)
def test_run_is_whole_after_a_crash_at_any_step(spark, store, tmp_path, monkeypatch, step):
    place = str(tmp_path / "feeds")

    class Lost(RuntimeError):
        pass

    def failing_after(owner, name, calls, broken=None):
        real, count = getattr(owner, name), [0]

        def wrapped(*args, **more):
            count[0] += 1
            out = real(*args, **more)
            if count[0] == calls:
                raise Lost(step)
            return out

        monkeypatch.setattr(owner, name, wrapped)

    first = fetch("B")
    if step == "publish":
        failing_after(landing.claims, "publish_once", 1)
    elif step == "first load":
        failing_after(landing.claims, "load_pass", 1)
    elif step == "append":
        failing_after(landing.Warehouse, "append", 1)
    elif step == "state":
        failing_after(landing.Warehouse, "replace", 3)
    elif step == "watermark":
        failing_after(landing.Warehouse, "replace", 4)
    else:
        failing_after(landing.claims, "messages_in", 1)
    with pytest.raises(Lost):
        landing.land(store, FEED, keys(spark, "A", "B", "C"), first, CTX, place, fetch())
    monkeypatch.undo()
    got = landing.land(store, FEED, keys(spark, "A", "B", "C"), first, CTX, place, fetch())
    assert [tuple(r)[2:] for r in got.collect()] == [(3, 3, 1, 0)] or step == "summary"
    assert held(store, FEED.table, "ticker", "year", "load_batch") == [
        (t, y, "dividend_year-r1") for t in "ABC" for y in (2022, 2023)]
    assert held(store, "ingest_state", "ticker") == [("A",), ("B",), ("C",)]
    assert {r.updated_at.date() for r in store.read("ingest_watermark").collect()} == {
        date(2024, 5, 10)}
    assert store.read("ingest_runs").count() == 1


def test_dividend_changes_reset_the_price_watermark(spark, store, tmp_path):
    urls: list[str] = []

    def prices(batch):
        urls.extend(r.url for r in batch.select("url").collect())
        return batch.withColumn("data", F.from_json(F.lit(
            '[{"date": "2024-05-09T00:00:00", "priceClose": 1}]'),
            "array<struct<date:string,priceClose:double>>")).withColumn("ok", F.lit(True))

    from factorloom.catalogue import TableSpec
    dim = spark.createDataFrame([("A", "qualified"), ("B", "qualified"), ("C", "unqualified")],
                                "ticker string, status string")
    store.replace(dim, TableSpec("gold_dim_company", "", (), ()))
    place = str(tmp_path / "feeds")
    runs.ingest_prices(store, CTX, prices, place)
    assert len(urls) == 3 and store.read("historical_quotes").count() == 3
    changed = spark.createDataFrame(
        [("A", 2023, 1.0, 0.0, CTX.started_at, CTX.started_at + timedelta(days=3), False),
         ("A", 2023, 2.0, 0.0, CTX.started_at + timedelta(days=3), None, False),
         ("B", 2023, 1.0, 0.0, CTX.started_at, None, False)],
        "ticker string, year int, cash_dividend double, stock_dividend double,"
        " valid_from timestamp, valid_to timestamp, is_deleted boolean")
    store.replace(changed, TableSpec("dividend_snapshot", "", (), ()))
    later = replace(CTX, run_id="r2", started_at=CTX.started_at + timedelta(days=3),
                    as_of=date(2024, 5, 13))
    urls.clear()
    runs.ingest_prices(store, later, prices, place)
    starts = {u.split("/symbols/")[1].split("/")[0]: u.split("startDate=")[1][:10] for u in urls}
    assert starts == {"A": "2016-01-01", "B": "2024-05-10", "VNINDEX": "2024-05-10"}
