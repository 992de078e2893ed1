"""Stored tables: generations, merges, evolution, upkeep, and the gate before publishing."""

from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from factorloom.catalogue import TABLES, TableSpec
from factorloom.operators import checks
from factorloom.operators.checks import Check, not_null
from factorloom.sources.store import Warehouse

AS_OF = datetime(2024, 5, 10, tzinfo=timezone.utc)


@pytest.fixture
def held(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def frame(spark, data, kind):
    return spark.createDataFrame(data, kind)


def folders(df):
    return {f for f in df.inputFiles()}


# Replacing ----------------------------------------------------------------------------------

def test_replace_may_read_what_it_replaces(spark, held):
    spec = TableSpec("t", "", (), ())
    held.replace(spark.range(3), spec)
    held.replace(held.read("t").where("id > 0"), spec)
    assert held.read("t").count() == 2 and len(held.generations("t")) == 2
    held.replace(spark.range(9), spec)
    assert held.read("t").count() == 9
    assert len(held.generations("t")) == 2


def test_failed_write_leaves_the_published_table(spark, held):
    spec = TableSpec("t", "", (), ())
    held.replace(spark.range(3), spec)
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        held.replace(broken, spec)
    assert held.read("t").count() == 3
    held.replace(spark.range(4), spec)
    assert held.read("t").count() == 4


def test_lookup_reads_few_rows(spark, held):
    keys = spark.range(400_000).selectExpr(
        "lpad(conv(CAST(id AS string), 10, 36), 6, '0') AS ticker", "id AS v")
    held.swap(keys, "serving", ("ticker",))
    found = held.read("serving").where("ticker = '0000ZZ'")
    assert [r.v for r in found.collect()] == [1295]
    plan = found._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [IsNotNull(ticker), EqualTo(ticker,0000ZZ)]" in plan.toString()
    nodes, scanned = [plan], None
    while nodes:
        node = nodes.pop()
        if "Scan" in node.nodeName():
            scanned = node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
    # a page or two of one file, of 400,000 rows
    assert scanned is not None and 0 < scanned <= 45_000


# Growing ------------------------------------------------------------------------------------

def test_append_adds_columns(spark, held):
    spec = TABLES["dividend_year"]
    held.append(frame(spark, [("a", 2020, "{}")], "ticker string, year int, data string"), spec)
    held.append(frame(spark, [("b", 2021, "{}", 1)],
                      "ticker string, year int, data string, extra int"), spec)
    got = held.read(spec.name)
    assert rows(got, "ticker", "year", "extra") == [("a", 2020, None), ("b", 2021, 1)]
    assert "bronze_ingested_time" in got.columns


@pytest.mark.parametrize("partition", [(), ("p",)])
def test_load_appended_twice_is_held_once(spark, held, partition):
    spec = TableSpec("t", "k int, p int", partition, ())
    held.append(frame(spark, [(1, 1)], "k int, p int"), spec, batch="b1")
    # the first try wrote a partition that the second does not
    held.append(frame(spark, [(7, 9)], "k int, p int"), spec, batch="b2")
    held.append(frame(spark, [(2, 1), (3, None)], "k int, p int"), spec, batch="b2")
    assert rows(held.read("t"), "k", "p") == [(1, 1), (2, 1), (3, None)]


def test_merge_keeps_null_partitions_and_null_keys(spark, held):
    spec = TableSpec("t", "", ("p",), ())
    kind = "k int, p int, v int"
    held.merge(frame(spark, [(1, None, 1), (2, 2000, 1), (None, None, 1)], kind), spec,
               ["k", "p"])
    held.merge(frame(spark, [(3, None, 3), (None, None, 9)], kind), spec, ["k", "p"])
    assert rows(held.read("t"), "k", "p", "v") == rows(frame(
        spark, [(1, None, 1), (2, 2000, 1), (3, None, 3), (None, None, 9)], kind), "k", "p", "v")


def test_merge_rewrites_touched_partitions_only(spark, held):
    spec = TableSpec("t", "", ("p",), ())
    kind = "k int, p string, v int"
    held.merge(frame(spark, [(1, "a", 1), (2, "b", 1)], kind), spec, ["k", "p"])
    untouched = {f for f in folders(held.read("t")) if "/p=b/" in f}
    held.merge(frame(spark, [(1, "a", 9), (3, "a", 3)], kind), spec, ["k", "p"])
    assert rows(held.read("t"), "k", "p", "v") == [(1, "a", 9), (2, "b", 1), (3, "a", 3)]
    assert untouched and untouched <= folders(held.read("t"))


def test_merge_finds_keys_that_move_between_partitions(spark, held):
    spec = TableSpec("t", "", ("p", "q"), ())
    kind = "k int, p int, q string, v int"
    held.merge(frame(spark, [(1, 1, "x", 1), (2, 1, "x", 1), (3, 2, "y", 1), (4, None, "z", 1),
                             (5, 3, None, 1)], kind), spec, ["k"])
    untouched = {f for f in folders(held.read("t")) if "/p=3/" in f}
    # 1 moves, 3 and 4 leave their partitions empty
    held.merge(frame(spark, [(1, 2, "y", 2), (3, 1, "x", 2), (4, 1, "x", 2)], kind), spec, ["k"])
    assert rows(held.read("t"), "k", "p", "q", "v") == rows(frame(spark, [
        (1, 2, "y", 2), (2, 1, "x", 1), (3, 1, "x", 2), (4, 1, "x", 2), (5, 3, None, 1)], kind),
        "k", "p", "q", "v")
    assert untouched and untouched <= folders(held.read("t"))


def test_merge_without_partitions_and_into_nothing(spark, held):
    spec = TableSpec("t", "", (), ())
    held.merge(frame(spark, [(1, "a")], "k int, v string"), spec, ["k"])
    held.merge(frame(spark, [(1, "b"), (2, "c")], "k int, v string"), spec, ["k"])
    held.merge(frame(spark, [], "k int, v string"), spec, ["k"])
    assert rows(held.read("t"), "k", "v") == [(1, "b"), (2, "c")]


def test_merge_and_compaction_keep_evolved_columns(spark, held):
    spec = TableSpec("t", "k int, p int", ("p",), ("k",))
    held.append(frame(spark, [(1, 1), (2, 2)], "k int, p int"), spec)
    held.append(frame(spark, [(3, 1, "x")], "k int, p int, b string"), spec)
    held.compact(spec)
    held.merge(frame(spark, [(4, 2)], "k int, p int"), spec, ["k", "p"])
    held.compact(spec)
    assert rows(held.read("t"), "k", "p", "b") == [
        (1, 1, None), (2, 2, None), (3, 1, "x"), (4, 2, None)]


# Upkeep -------------------------------------------------------------------------------------

def test_compaction_follows_partition_sizes(spark, held):
    spec = TableSpec("t", "", ("p",), ())
    df = spark.range(200_000).selectExpr("id", "uuid() AS u", "CAST(id < 1000 AS int) AS p")
    held.append(df.repartition(16), spec)
    held.append(frame(spark, [(1, "u", 7), (2, "v", None)], "id bigint, u string, p int"), spec)
    single = {f for f in folders(held.read("t")) if "/p=7/" in f}
    held.compact(spec, target_mb=1)
    files = [f.split("/")[-2] for f in held.read("t").inputFiles()]
    assert files.count("p=1") == 1 and 4 <= files.count("p=0") < 16
    assert single <= folders(held.read("t"))
    assert held.read("t").count() == 200_002


def test_compaction_of_a_replaced_table(spark, held):
    spec = TableSpec("t", "", (), ("id",))
    held.replace(spark.range(1000).repartition(8), spec)
    held.compact(spec)
    assert held.file_count("t") == 1 and held.read("t").count() == 1000


def test_expiry_drops_day_partitions(spark, held):
    spec = TableSpec("t", "", ("day",), ())
    held.append(spark.sql("SELECT id, date_add(DATE'2024-01-01', CAST(id AS int)) AS day "
                          "FROM range(30)"), spec)
    held.expire("t", "day", date(2024, 1, 30), 10)
    assert rows(held.read("t").agg(F.min("day"), F.count("id")), "*") == [(date(2024, 1, 20), 11)]


# Checks -------------------------------------------------------------------------------------

DATA = [(1, "a", 5, AS_OF, "r"), (2, "b", 50, AS_OF, "r"), (2, "b", None, AS_OF, "r"),
        (3, None, -1, AS_OF, "r"), (None, "zz", 7, AS_OF, "r")]
KIND = "k int, s string, v int, at timestamp, run string"
DECLARED = (
    Check("columns", ("k", "S", "gone")), *not_null("k", "s"), Check("unique", ("k",)),
    Check("unique", ("k", "s")), Check("between", ("v",), (0, 10), error_over=5),
    Check("between", ("v",), (None, 40), where="k = 2"), Check("in_set", ("s",), ("a", "b")),
    Check("regex", ("s",), ("^[a-z]$",)), Check("null", ("v",), where="k = 2"),
    Check("at_least", ("v", "k")), Check("rate", ("s",), ("b",), warn_over=3000, error_over=4000),
    Check("row_count", (), (1, 4)), Check("distinct_count", ("run",), (1,)),
    Check("recent", ("at",), (32,)), Check("relationship", ("k",), ("other", "id")),
    Check("relationship", ("k",), ("other", "id"), where="k < 3"))
WANT = [1, 1, 1, 1, 1, 2, 1, 1, 1, 1, 1, 4000, 1, 0, 0, 1, 0]


def test_checks_compile_to_one_scan(spark, held):
    df = frame(spark, DATA, KIND)
    held.replace(df, TableSpec("t", "", (), ()))
    parents = {"other": spark.range(3)}
    result = checks.compiled(held.read("t"), DECLARED, "t", parents, AS_OF)
    found = [(r["test_name"], r["failures"], r["status"]) for r in result.collect()]
    assert [f[1] for f in found] == WANT
    assert [f[2] for f in found if f[0].startswith("between_v")] == ["warn", "fail"]
    assert [f[2] for f in found if f[0] == "rate_s"] == ["warn"]
    plan = checks.compiled(held.read("t"), DECLARED[:14], "t", None, AS_OF)._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Relation") == 1


def test_audit_of_a_writing_job_equals_the_compiled_checks(spark, held):
    df = frame(spark, DATA, KIND)
    parents = {"other": spark.range(3)}
    soft = tuple(Check(c.kind, c.columns, c.values, c.where, error_over=10_000) for c in DECLARED)
    results = held.replace(df, TableSpec("t", "", (), ()), soft, parents, AS_OF)
    assert [r["failures"] for r in results.collect()] == WANT


def test_checks_of_an_empty_table(spark, held):
    results = held.replace(frame(spark, [], KIND), TableSpec("t", "", (), ()), (
        *not_null("k"), Check("unique", ("k",)), Check("rate", ("s",), ("b",))))
    assert [r["failures"] for r in results.collect()] == [0, 0, 0]


def test_failing_check_publishes_nothing(spark, held):
    spec = TableSpec("t", "", (), ())
    held.replace(spark.range(3), spec, (Check("unique", ("id",)),))
    for bad in (Check("unique", ("id",)), Check("between", ("id",), (0, 1))):
        with pytest.raises(checks.FailedChecks, match=bad.name):
            held.replace(spark.range(3).union(spark.range(2)), spec, (bad, *not_null("id")))
        assert rows(held.read("t"), "id") == [(0,), (1,), (2,)]
        assert len(held.generations("t")) == 1
    grown = TableSpec("g", "", ("p",), ())
    held.merge(frame(spark, [(1, 1)], "k int, p int"), grown, ["k"], not_null("k"))
    with pytest.raises(checks.FailedChecks, match="not_null_k"):
        held.merge(frame(spark, [(2, 1), (None, 1)], "k int, p int"), grown, ["k"], not_null("k"))
    assert rows(held.read("g"), "k", "p") == [(1, 1)]


def test_all_failing_checks_are_named(spark, held):
    bad = [Check("between", (f"c{i}",), (1, 2)) for i in range(30)]
    df = spark.range(1).select(*[F.lit(0).alias(f"c{i}") for i in range(30)], "id")
    with pytest.raises(checks.FailedChecks) as stopped:
        held.replace(df, TableSpec("t", "", (), ()), (*bad, *not_null("id")))
    assert all(f"between_c{i}" in str(stopped.value) for i in range(30))
    assert "not_null_id" not in str(stopped.value)
