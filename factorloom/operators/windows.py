"""Time-series windows within one entity.

Each operator expects at most one row per entity and period (deduplicate first), so a window
partition is bounded by the calendar, not by the data: an entity that holds a third of all
raw rows still has one row per day or quarter here.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# What runs inside tasks is shipped by value: executors need numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _series(key: Sequence[str], order: str):
    return W.partitionBy(*key).orderBy(order)


def ttm(df: DataFrame, key: Sequence[str], order: str, measures: Sequence[str],
        n: int = 4, suffix: str = "_ttm") -> DataFrame:
    """Sums over the current and the ``n - 1`` preceding rows."""
    frame = _series(key, order).rowsBetween(-(n - 1), 0)
    return df.withColumns({f"{m}{suffix}": F.sum(m).over(frame) for m in measures})


def gap(order: str, key: Sequence[str], n: int) -> Column:
    """Index distance to the row ``n`` rows back; equals ``n`` when no period is missing."""
    return F.col(order) - F.lag(order, n).over(_series(key, order))


def gap_lag(df: DataFrame, key: Sequence[str], order: str, columns: Mapping[str, str | Column],
            n: int, gap_name: str = "gap") -> DataFrame:
    """Values ``n`` rows back (out -> column) with the index gap that proves continuity."""
    series = _series(key, order)
    lagged = {out: F.lag(c, n).over(series) for out, c in columns.items()}
    return df.withColumns({**lagged, gap_name: gap(order, key, n)})


def multi_lag(df: DataFrame, key: Sequence[str], order: str,
              plan: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Several lags of several columns in one sort (out -> (column, rows back))."""
    series = _series(key, order)
    return df.withColumns({out: F.lag(c, n).over(series) for out, (c, n) in plan.items()})


def rolling_sum(df: DataFrame, key: Sequence[str], order: str, columns: Mapping[str, str],
                n: int) -> DataFrame:
    frame = _series(key, order).rowsBetween(-(n - 1), 0)
    return df.withColumns({out: F.sum(c).over(frame) for out, c in columns.items()})


# Counts, means, centred second moments and the co-moment of a pair, each an array with one
# element per row.
_Moments = dict[str, np.ndarray]


def _alone(parts: Sequence[np.ndarray], there: np.ndarray) -> _Moments:
    """The moments of single rows; a pair counts where both values are there."""
    out = {"n": there.astype("float64")}
    for i, values in enumerate(parts):
        out[f"mean{i}"] = np.where(there, values, 0.0)
        out[f"m{i}"] = np.zeros(len(values))
    if len(parts) == 2:
        out["co"] = np.zeros(len(there))
    return out


def _together(a: _Moments, b: _Moments) -> _Moments:
    """The moments of two runs of rows; no rows are all zeros.

    Only differences of means enter, so runs of one and the same value have exactly that mean
    and no spread.
    """
    n, m = a["n"], b["n"]
    share = m / np.maximum(n + m, 1.0)
    apart = [b[f"mean{i}"] - a[f"mean{i}"] for i in range(2) if f"mean{i}" in a]
    out = {"n": n + m}
    for i, d in enumerate(apart):
        out[f"mean{i}"] = a[f"mean{i}"] + d * share
        out[f"m{i}"] = a[f"m{i}"] + b[f"m{i}"] + d * d * n * share
    if len(apart) == 2:
        out["co"] = a["co"] + b["co"] + apart[0] * apart[1] * n * share
    return out


def _back(moments: _Moments, rows: int, place: np.ndarray) -> _Moments:
    """The moments ``rows`` rows before, none before an entity's first row."""
    inside = place >= rows

    def moved(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        out[rows:] = x[:max(len(x) - rows, 0)]
        return np.where(inside, out, 0.0)

    return {k: moved(v) for k, v in moments.items()}


def _last_rows(run: _Moments, n: int, place: np.ndarray) -> _Moments:
    """The moments of the last ``n`` rows from those of each row; ``place`` is a row's number
    within its entity.

    The moments of the last 2, 4, 8, ... rows are those of half as many and of the half before;
    a frame is put together from the powers of two in its length.  So a row costs the logarithm
    of the frame, and nothing old is ever subtracted.
    """
    whole, width, covered = None, 1, 0
    while width <= n:
        if n & width:
            whole = run if whole is None else _together(whole, _back(run, covered, place))
            covered += width
        if 2 * width <= n:
            run = _together(run, _back(run, width, place))
        width *= 2
    return whole


def _starts(keys: Sequence[pa.ChunkedArray]) -> np.ndarray:
    """Where rows have other keys than the row before, NULL being a key; not the first row."""
    other = np.zeros(max(len(keys[0]) - 1, 0), dtype=bool) if keys else np.zeros(0, dtype=bool)
    for k in keys:
        there = k.is_valid().to_numpy(zero_copy_only=False)
        unequal = pc.fill_null(pc.not_equal(k[1:], k[:-1]), False)
        other |= unequal.to_numpy(zero_copy_only=False) | (there[1:] != there[:-1])
    return other


def _whole_entities(batches: Iterator[pa.RecordBatch], key: Sequence[str]) -> Iterator[pa.Table]:
    """Rows in key order as tables that end with the last row of an entity."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        before = held[-1].slice(held[-1].num_rows - 1) if held else batch.slice(0, 1)
        seam = pa.Table.from_batches([before, batch])
        starts = np.flatnonzero(_starts([seam[k] for k in key])) if key else []
        if len(starts):
            last = int(starts[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _rolling(df: DataFrame, key: Sequence[str], order: str, n: int,
             series: Mapping[str, tuple[Sequence[str], int, Sequence[str]]]) -> DataFrame:
    """Moments over the last ``n`` rows.

    ``series`` names the columns of a row that must be there for it to count, how many of them
    are values (none: counts only), and the moments wanted: n, mean0, m0 (centred second
    moment), for a pair mean1, m1 and co as well, each with the series' name behind.

    Spark brings an entity's rows together and sorts them; numpy adds the moments of whole
    entities up, as many at a time as an Arrow batch holds.
    """
    keep, kinds = df.columns, dict(df.dtypes)
    used = {c for columns, _, _ in series.values() for c in columns}
    inputs = {c: c if kinds[c] == "double" else f"_in_{c}" for c in used}
    wanted = {s: (tuple(inputs[c] for c in columns), width, tuple(names))
              for s, (columns, width, names) in series.items()}
    key = list(key)
    rows = df.select(*keep, *[F.col(c).cast("double").alias(name) for c, name in inputs.items()
                              if c != name])
    rows = rows.repartition(*key) if key else rows.repartition(1)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_entities(batches, key):
            first = np.concatenate([[True], _starts([table[k] for k in key])]) if key else (
                np.arange(table.num_rows) == 0)
            at = np.arange(table.num_rows)
            place = at - np.maximum.accumulate(np.where(first, at, 0))
            found = table.select(keep)
            for s, (columns, width, names) in wanted.items():
                there = reduce(np.logical_and, [table[c].is_valid().to_numpy() for c in columns])
                values = [table[c].fill_null(0.0).to_numpy() for c in columns[:width]]
                whole = _last_rows(_alone(values, there), n, place)
                for m in names:
                    found = found.append_column(f"_{m}_{s}", pa.array(whole[m]))
            yield from found.combine_chunks().to_batches()

    out = StructType([*df.schema.fields, *[
        StructField(f"_{m}_{s}", DoubleType()) for s, (_, _, ms) in wanted.items() for m in ms]])
    return rows.sortWithinPartitions(*key, order).mapInArrow(moments, out)


def rolling_stddev(df: DataFrame, key: Sequence[str], order: str, columns: Mapping[str, str],
                   n: int, counts: Mapping[str, str] | None = None) -> DataFrame:
    """Sample deviation over the last ``n`` rows (out -> column), with optional value counts."""
    rolled = _rolling(df, key, order, n,
                      {out: ([c], 1, ["n", "m0"]) for out, c in columns.items()})
    results = {}
    for out in columns:
        count = F.col(f"_n_{out}")
        results[out] = F.when(count > 1, F.sqrt(F.col(f"_m0_{out}") / F.greatest(
            count - 1, F.lit(1.0))))
    for name, out in (counts or {}).items():
        results[name] = F.col(f"_n_{out}").cast("bigint")
    return rolled.select(*df.columns, *[v.alias(k) for k, v in results.items()])


def rolling_corr(df: DataFrame, key: Sequence[str], order: str, x: str, y: str, n: int,
                 out: str = "corr", count: str | None = None) -> DataFrame:
    """Pearson correlation over the last ``n`` rows, pairs with a NULL left out."""
    series = {"xy": ([x, y], 2, ["n", "m0", "m1", "co"])}
    if count:
        # values of x whether or not y is there
        series["x"] = ([x], 0, ["n"])
    rolled = _rolling(df, key, order, n, series)
    spread_x, spread_y = F.col("_m0_xy"), F.col("_m1_xy")
    defined = (F.col("_n_xy") > 1) & (spread_x > 0) & (spread_y > 0)
    joint = F.col("_co_xy") / F.when(defined, F.sqrt(spread_x) * F.sqrt(spread_y))
    results = [F.when(defined, joint).alias(out)]
    if count:
        results.append(F.col("_n_x").cast("bigint").alias(count))
    return rolled.select(*df.columns, *results)


def running_stats(df: DataFrame, key: Sequence[str], order: str, value: str,
                  ends: str) -> DataFrame:
    """Mean, deviation, size and first/last ``ends`` of everything up to the current row."""
    frame = _series(key, order).rowsBetween(W.unboundedPreceding, 0)
    x = F.col(value).cast("double")
    return df.withColumns({
        "training_avg": F.avg(x).over(frame),
        "training_stddev": F.stddev_samp(x).over(frame),
        "training_set_size": F.count(x).over(frame),
        "training_end": F.last_value(ends).over(frame),
        "training_start": F.first_value(ends).over(frame),
    })
