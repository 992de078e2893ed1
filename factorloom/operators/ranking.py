"""Ranks and z-scores over groups of any size.

No task holds a group.  Equal values are counted first, so that a value of many rows is one; the
values of a group are cut at approximate quantiles into buckets; a value's rank is the rows in the
buckets before and those before it in its own.  All columns go through this together, as
(row, column, value); scores are those of the distinct values, from sums per group, and one
join by value and one by row bring both back.  The cuts are stored before use, as are the rows:
what is computed twice must come out the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factorloom.session import cut_lineage, small_side

_RANGE, _COUNT, _BEFORE, _ROW = "_range", "_count", "_before", "_row"
# A group's values are cut into this many steps of as many buckets, at quantiles that are off by
# one ACCURACY-th of the rows at most.
STEP = 8
ACCURACY = 1000


def _outputs(cols: Mapping[str, str] | Sequence[str], suffix: str) -> dict[str, str]:
    return dict(cols) if isinstance(cols, Mapping) else {f"{c}{suffix}": c for c in cols}


def _order(column: str, descending: bool) -> Column:
    c = F.col(column)
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def _positions(counted: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add the number of rows ordered before each row of ``counted`` within its group.

    ``counted`` has one row per group and order value, with its row count in ``_count``.
    """
    keys = [F.col(b) for b in by]
    # The range number is stored before use: both readers below must see one partitioning.
    ranged = cut_lineage(
        counted.repartitionByRange(*keys, *order).withColumn(_RANGE, F.spark_partition_id())
    )
    earlier_ranges = (
        W.partitionBy(*by).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    )
    sizes = ranged.groupBy(*by, _RANGE).agg(F.sum(_COUNT).alias("_size"))
    starts = sizes.select(
        *by, _RANGE, F.coalesce(F.sum("_size").over(earlier_ranges), F.lit(0)).alias("_start")
    )
    earlier_rows = (
        W.partitionBy(*by, _RANGE).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum(_COUNT).over(earlier_rows), F.lit(0))
    same = [F.col(f"l.{b}").eqNullSafe(F.col(f"r.{b}")) for b in (*by, _RANGE)]
    # One row per range and group: as few as there are tasks and groups.
    starts = small_side(starts).alias("r")
    placed = ranged.withColumn("_inside", inside).alias("l").join(starts, same)
    rest = [F.col(f"l.{c}") for c in counted.columns]
    return placed.select(*rest, (F.col("l._inside") + F.col("r._start")).alias(_BEFORE))


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [
        F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns], F.lit(True))


def _value_ranks(counted: DataFrame, by: Sequence[str], descending: bool) -> DataFrame:
    """Competition ranks of values: ``counted`` (by, _value, _count) with ``_rank``."""
    cuts = [i / STEP ** 2 for i in range(1, STEP ** 2)]
    found = counted.groupBy(*by).agg(
        F.percentile_approx("_value", cuts, F.lit(ACCURACY)).alias("_cuts"))
    # every STEP-th cut first, then those between two of them
    bounds = small_side(found.select(
        *by, F.filter("_cuts", lambda c, i: i % STEP == STEP - 1).alias("_coarse"),
        F.transform(F.sequence(F.lit(0), F.lit(STEP - 1)), lambda i: F.slice(
            F.col("_cuts"), i * STEP + 1, F.lit(STEP - 1))).alias("_fine")))

    def passed(bounds_: Column) -> Column:
        return F.size(F.filter(bounds_, lambda c: F.col("l._value") > c))

    bucketed = counted.alias("l").join(bounds.alias("r"), _same("l", "r", by)).select(
        "l.*", passed(F.col("r._coarse")).alias("_step"), "r._fine").alias("l").select(
        *[f"l.{c}" for c in counted.columns],
        (F.col("_step") * STEP + passed(F.get("_fine", F.col("_step")))).alias("_bucket"))
    way = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    earlier = W.unboundedPreceding, -1
    starts = bucketed.groupBy(*by, "_bucket").agg(F.sum(_COUNT).alias("_size")).select(
        *by, "_bucket", F.coalesce(F.sum("_size").over(
            W.partitionBy(*by).orderBy(way).rowsBetween(*earlier)), F.lit(0)).alias("_start"))
    own = W.partitionBy(*by, "_bucket").orderBy(_order("_value", descending))
    inside = F.coalesce(F.sum(_COUNT).over(own.rowsBetween(*earlier)), F.lit(0))
    placed = bucketed.withColumn("_inside", inside).alias("l").join(
        starts.alias("r"), _same("l", "r", (*by, "_bucket")))
    return placed.select(*[f"l.{c}" for c in counted.columns],
                         (F.col("l._inside") + F.col("r._start") + 1).alias("_rank"))


def _with_scores(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    """``ranked`` values with ``_score``: their ranks, standardised over the group's rows."""
    n, r = F.col(_COUNT).cast("double"), F.col("_rank").cast("double")
    sums = ranked.groupBy(*by).agg(F.sum(n).alias("_n"), F.sum(n * r).alias("_r1"),
                                   F.sum(n * r * r).alias("_r2"))
    mean = F.col("r._r1") / F.col("r._n")
    # ranks are spread evenly: the difference keeps nearly all digits
    spread = F.greatest(F.col("r._r2") - F.col("r._r1") * mean, F.lit(0.0))
    deviation = F.sqrt(spread / F.nullif(F.col("r._n") - 1, F.lit(0.0)))
    joined = ranked.alias("l").join(sums.alias("r"), _same("l", "r", by))
    return joined.select("l.*", _standardised(F.col("l._rank"), mean, deviation).alias("_score"))


def _ranked(df: DataFrame, by: Sequence[str], cols: Mapping[str, str], descending: bool,
            scored: bool) -> DataFrame:
    """``df`` with ranks of columns (out -> source), or with the scores of the ranks."""
    rows = cut_lineage(df.withColumn(_ROW, F.monotonically_increasing_id()), "ranked-rows")
    kinds = {df.schema[c].dataType for c in cols.values()}
    # columns of several types are compared as doubles
    kind = kinds.pop() if len(kinds) == 1 else "double"
    cells = F.array(*[F.struct(F.lit(i).alias("_column"), F.col(c).cast(kind).alias("_value"))
                      for i, c in enumerate(cols.values())])
    long = rows.select(_ROW, *by, F.inline(cells)).where("_value IS NOT NULL")
    keys = ["_column", *by]
    values = _value_ranks(long.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias(_COUNT)),
                          keys, descending)
    values = _with_scores(values, keys) if scored else values
    out = "_score" if scored else "_rank"
    match = _same("l", "r", keys) & (F.col("l._value") == F.col("r._value"))
    found = long.alias("l").join(values.alias("r"), match).select(
        f"l.{_ROW}", "l._column", f"r.{out}")
    # one per row and column, spread by value: moved as they are, not as wide rows of one each
    wide = found.repartition(_ROW).groupBy(_ROW).agg(*[
        F.max(F.when(F.col("_column") == i, F.col(out))).alias(name)
        for i, name in enumerate(cols)])
    return rows.join(wide, _ROW, "left").select(*df.columns, *cols)


def xs_rank(df: DataFrame, by: Sequence[str], cols: Mapping[str, str] | Sequence[str],
            descending: bool = False, nullable: bool = True) -> DataFrame:
    """Rank columns within ``by`` groups (out -> source), ties sharing the smaller rank.

    ``nullable`` leaves rows without a value unranked; otherwise they share the last rank.
    """
    outs = _outputs(cols, "_rank")
    return _fill_last(_ranked(df, by, outs, descending, False), by, outs, nullable)


def _fill_last(df: DataFrame, by: Sequence[str], outs: Mapping[str, str],
               nullable: bool) -> DataFrame:
    if nullable:
        return df
    filled = {c: F.count(c).alias(f"_n_{o}") for o, c in outs.items()}
    sizes = small_side(df.groupBy(*by).agg(*filled.values()))
    match = [F.col(f"l.{b}").eqNullSafe(F.col(f"r.{b}")) for b in by]
    joined = df.alias("l").join(sizes.alias("r"), match).select("l.*", *[
        f"r._n_{o}" for o in outs])
    last = {o: F.coalesce(F.col(o), F.col(f"_n_{o}") + 1) for o in outs}
    return joined.withColumns(last).drop(*[f"_n_{o}" for o in outs])


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[Column],
                out: str) -> DataFrame:
    """Row numbers within groups of any size; ``order`` should be unique within a group."""
    placed = _positions(df.withColumn(_COUNT, F.lit(1)), by, order)
    return placed.withColumn(out, F.col(_BEFORE) + 1).drop(_COUNT, _BEFORE)


def _standardised(value: Column, mean: Column, deviation: Column) -> Column:
    return (value - mean) / F.nullif(deviation, F.lit(0.0))


def zscore(df: DataFrame, by: Sequence[str], cols: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """(x - mean) / sample deviation per group (out -> source), NULL when the deviation is 0.

    Means and deviations come from a combining aggregate that is joined back, by broadcast
    when the groups are few, so that no group has to meet in one task.  With no group columns
    they enter as scalar subqueries.
    """
    outs = _outputs(cols, "_z")
    stats = []
    for out, column in outs.items():
        x = F.col(column).cast("double")
        stats += [F.avg(x).alias(f"_m_{out}"), F.stddev_samp(x).alias(f"_s_{out}")]
    if not by:
        table = df.agg(*stats)

        def scalar(name: str) -> Column:
            return table.select(name).scalar()

        return df.withColumns({
            out: _standardised(F.col(c).cast("double"), scalar(f"_m_{out}"), scalar(f"_s_{out}"))
            for out, c in outs.items()
        })
    match = [F.col(f"l.{b}").eqNullSafe(F.col(f"r.{b}")) for b in by]
    table = small_side(df.groupBy(*by).agg(*stats))
    joined = df.alias("l").join(table.alias("r"), match)
    scores = [
        _standardised(F.col(f"l.{c}").cast("double"), F.col(f"r._m_{out}"),
                      F.col(f"r._s_{out}")).alias(out)
        for out, c in outs.items()
    ]
    return joined.select("l.*", *scores)


def rank_and_score(df: DataFrame, by: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Ascending rank, then z-score of the rank (score -> source column)."""
    return _ranked(df, by, cols, False, True)
