"""Exact top-k inner products with an impact-ordered index, processed score at a time.

Vectors are quantised to integers.  The index is cut into blocks of vectors; in a block a
posting segment is the list of vectors whose component in one dimension has one quantised
value (*level*).  For a query a segment has an impact: how much more the component can add
to the score than the worst component of that dimension.  Segments are processed in waves of
falling impact.  After each wave a vector's score lies between known bounds, as every
dimension it was not met in adds no more than the wave's least impact.  A vector is given up only
when its upper bound is below a score that k others are proven to reach; processing stops
when few vectors are left, and those get their exact scores.

A block is one stored row.  Queries are broadcast in sets of bounded size, and each set reads the
stored blocks where they lie: no posting is moved for it.

Nulls, empties and repeats: a vector that is null or empty, or holds a null or non-finite
component, takes no part, nor does one whose scores might pass 2^58 (its size times the square of
its largest component); a row with a null id is a candidate that loses ties, never a query;
rows that repeat an id are candidates each; vectors are compared with those of the same
length.  Only the two columns named are read, others may have any name.  An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factorloom.llm.frames import stored

SCALE = 1024
LEVEL_BITS = 4
BLOCK_ROWS = 1 << 15
WAVES = 8
_NO_ID = np.iinfo(np.int64).max
LIMIT = 1 << 58
_PARTS = {"rows": np.int64, "ids": np.int64, "vectors": np.int32, "dims": np.int32,
          "levels": np.int32, "ends": np.int64, "at": np.int32}
_INDEX = "size int, " + ", ".join(f"{part} binary" for part in _PARTS)


def quantise(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, vector) of the usable rows, components as floor(scale * x)."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda v: v * scale)
    unfit = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    largest = F.array_max(F.transform("x", lambda v: F.abs(F.floor(v)).cast("double")))
    return stored(
        vectors.select(F.col("vec_id").cast("long"), scaled.alias("x")).where(F.size("x") > 0)
        .select("*", unfit.alias("unfit"), largest.alias("largest"))
        .where(~F.col("unfit")
               & (F.size("x") * F.col("largest") * F.col("largest") < float(LIMIT)))
        .select(F.monotonically_increasing_id().alias("row"), "vec_id",
                F.transform("x", lambda v: F.floor(v).cast("int")).alias("vector")), "vectors")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def build_index(quantised: DataFrame, block_rows: int = BLOCK_ROWS,
                level_bits: int = LEVEL_BITS) -> DataFrame:
    """The stored index, a row per block: the vectors' rows, ids and components in order, and the
    posting segments by dimension and level, as ends in the list of places."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}

        def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks()
            values = _matrix(rows["vector"].combine_chunks())
            levels = values >> level_bits
            dims, heights, ends, at = [], [], [], []
            for d in range(values.shape[1]):
                order = np.argsort(levels[:, d], kind="stable")
                own = levels[order, d]
                last = np.flatnonzero(np.r_[own[1:] != own[:-1], True])
                dims.append(np.full(len(last), d))
                heights.append(own[last])
                ends.append(d * len(own) + last + 1)
                at.append(order)
            found = {"rows": rows["row"].to_numpy(), "vectors": values,
                     "ids": rows["vec_id"].fill_null(_NO_ID).to_numpy(),
                     **{k: np.concatenate(v) for k, v in (
                         ("dims", dims), ("levels", heights), ("ends", ends), ("at", at))}}
            return pa.RecordBatch.from_pydict({
                "size": pa.array([values.shape[1]], pa.int32()),
                **{part: pa.array([found[part].astype(kind).tobytes()], pa.binary())
                   for part, kind in _PARTS.items()}})

        for batch in batches:
            size = batch.column(2).value_lengths().to_numpy()
            for n in np.unique(size).tolist():
                held.setdefault(n, []).append(batch.filter(pa.array(size == n)))
                if sum(map(len, held[n])) >= block_rows:
                    yield flush(held.pop(n))
        for parts in held.values():
            yield flush(parts)

    return stored(quantised.mapInArrow(index, _INDEX), "impacts")


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point where that is exact."""
    most = int(np.abs(vectors).max(initial=0)) * int(np.abs(query).max(initial=0)) * len(query)
    if most < 1 << 53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return vectors @ query


def possible(query: np.ndarray, segments: tuple, n: int, k: int, proven: float,
             level_bits: int, enough: int) -> np.ndarray:
    """The vectors of a block that may be among the query's best ``k``.

    ``segments`` has dimension, level, start and end in ``flat`` of each posting segment, and
    ``flat``; ``proven`` is a score that k vectors are known to reach.
    """
    dims, levels, starts, ends, flat = segments
    low = levels << level_bits
    high = low + (1 << level_bits) - 1
    weight = query[dims]
    least, most = np.minimum(weight * low, weight * high), np.maximum(weight * low, weight * high)
    base = np.full(len(query), np.iinfo(np.int64).max)
    np.minimum.at(base, dims, least)
    impact = most - base[dims]
    order = np.argsort(-impact, kind="stable")
    sizes = (ends - starts)[order]
    falling = impact[order]
    done = np.cumsum(sizes)
    cuts = np.unique(np.searchsorted(done, done[-1] * (1 + np.arange(WAVES)) / WAVES) + 1)
    total, met = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    floor, slack = int(base.sum()), (most - least)
    sure = np.zeros(n, dtype=np.int64)
    a = 0
    left = np.arange(n)
    for b in np.minimum(cuts, len(order)).tolist():
        own = order[a:b]
        at = np.concatenate([flat[s:e] for s, e in zip(starts[own], ends[own])])
        size = sizes[a:b]
        total += np.bincount(at, np.repeat(falling[a:b], size), minlength=n).astype(np.int64)
        sure += np.bincount(at, np.repeat((impact - slack)[own], size),
                            minlength=n).astype(np.int64)
        met += np.bincount(at, minlength=n)
        a = b
        if n > k:
            # not met dimensions add nothing at least
            proven = max(proven, floor + int(np.partition(sure, n - k)[n - k]))
        rest = int(falling[b]) if b < len(order) else 0
        left = np.flatnonzero(floor + total + (len(query) - met) * rest >= proven)
        if len(left) <= enough or b == len(order):
            break
    return left


def search(index: DataFrame, queries: DataFrame, k: int = 10, query_block: int = 2048,
           level_bits: int = LEVEL_BITS) -> DataFrame:
    """The ``k`` best candidates of each query: query_row, query_id, rank, vec_id, score.

    ``queries`` has rows as ``quantise`` makes them; a row is no candidate for itself.  The
    query set is broadcast in blocks of bounded size, whatever its size.
    """
    spark = index.sparkSession
    blocks = max(1, -(-queries.count() // query_block))
    part = F.pmod(F.xxhash64("row"), F.lit(blocks))
    found = []
    for i in range(blocks):
        rows = queries.where(part == i).select("row", "vec_id", "vector").collect()
        if rows:
            found.append(stored(_search(index, spark.sparkContext.broadcast(
                [(r[0], r[1], np.array(r[2], dtype=np.int64)) for r in rows]), k, level_bits),
                "best"))
    if not found:
        return spark.createDataFrame(
            [], "query_row long, query_id long, rank int, vec_id long, score long")
    best = found[0]
    for more in found[1:]:
        best = best.union(more)
    order = Window.partitionBy("query_row").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_row", "query_id", "rank", "vec_id", "score"))


def _search(index: DataFrame, shared, k: int, level_bits: int) -> DataFrame:
    """Each block's best candidates of every query."""

    def find(block: dict[str, np.ndarray], size: int) -> pa.RecordBatch | None:
        own, ids = block["rows"], block["ids"]
        vectors = block["vectors"].reshape(-1, size).astype(np.int64)
        ends = block["ends"]
        segments = (block["dims"], block["levels"].astype(np.int64), np.r_[0, ends[:-1]], ends,
                    block["at"])
        n = len(vectors)
        some = np.arange(0, n, max(1, min(32, n // (4 * k + 4))))
        out = []
        for row, query_id, query in shared.value:
            if len(query) != size:
                continue
            # any k other vectors prove a score that the best k reach
            known = _products(vectors[some], query)[own[some] != row]
            proven = (float(np.partition(known, len(known) - k)[len(known) - k])
                      if len(known) >= k else -np.inf)
            left = possible(query, segments, n, k + 1, proven, level_bits,
                            max(4 * k, n // 64))
            left = left[own[left] != row]
            scores = _products(vectors[left], query)
            best = np.lexsort((ids[left], -scores))[:k]
            out.append((np.full(len(best), row), np.full(len(best), query_id),
                        ids[left[best]], scores[best]))
        if not out:
            return None
        rows, asked, vec, scores = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_pydict({
            "query_row": pa.array(rows), "query_id": pa.array(asked),
            "vec_id": pa.array(vec, mask=vec == _NO_ID), "score": pa.array(scores)})

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                block = {part: np.frombuffer(batch.column(j + 1)[i].as_py(), dtype=kind)
                         for j, (part, kind) in enumerate(_PARTS.items())}
                found = find(block, batch.column(0)[i].as_py())
                if found is not None:
                    yield found

    return index.mapInArrow(match, "query_row long, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The rows whose id is divisible by ``every``, each against every other row."""
    quantised = quantise(vectors)
    return search(build_index(quantised), quantised.where(F.col("vec_id") % every == 0), k)


def digest(result: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return result.select("query_id", "rank", "vec_id", "score")
