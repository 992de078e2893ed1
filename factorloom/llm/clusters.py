"""Centroid clustering in exact integers, with lower bounds loosened by geometry.

Lloyd's rounds: each vector goes to its nearest centroid, each centroid to the mean of its
vectors.  A vector carries a lower bound of its distance to every centroid but its own.  When
centroids move, the bound has to give way, but by less than the moved distance: all vectors of a
cluster lie in a sphere around the cluster's old centroid.  Seen from the midpoint of another
centroid's move, in the plane of the move and the sphere's centre, a point at angle phi to the
move comes nearer by at most cos(phi) times the move, since the points that come nearer by more
lie inside a hyperbola whose asymptotes have that angle.  The sphere's least angle is that
of its centre less the angle its radius fills; beyond a right angle nothing comes nearer.  The
loosening of a cluster is the largest of these over the other centroids.

A vector whose exact distance to its own centroid is below its bound, or below half the distance
of that centroid to any other, stays; the rest are *ambiguous* and scanned exactly against all
centroids.  Bounds are floating point with a margin and only ever spare a scan: results are
integers throughout.

Every round reads the stored rows of the round before and stores its own, so a lost executor
costs a re-read.  Centroids, sums and radii are a row per cluster.

Nulls, empties and repeats: a vector that is null, has another number of components than asked
for, or holds a null or non-finite component takes no part, nor does one with a quantised
component beyond 2^27, whose distances might not fit a long; rows that repeat an id are vectors
each; a null id takes part and is a first centroid only after all others; equal hashes go by the
vector, equal distances by the smaller cluster number.  Fewer vectors than clusters make a cluster
each.  A sum of distances beyond a long is null.  Only the two columns named are read, others may
have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.llm.frames import stored

SCALE = 256
DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
LIMIT = 1 << 27
# Bounds are loosened by this share more than the geometry asks for, against rounding.
MARGIN = 1e-9
_STATE = ("vec_id long, vector array<int>, cluster int, distance long, lower double, "
          "scanned boolean")


def usable(embeddings: DataFrame, scale: int = SCALE, size: int = DIMENSIONS) -> DataFrame:
    """(vec_id, vector) of the rows that take part, components as floor(scale * x)."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda v: v * scale)
    unfit = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= float(LIMIT)))
    return embeddings.select(F.col("vec_id").cast("long"), scaled.alias("x")).where(
        (F.size("x") == size) & ~unfit).select(
        "vec_id", F.transform("x", lambda v: F.floor(v).cast("int")).alias("vector"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = 2) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of seed and id, in its order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.array([r[0] for r in rows], dtype=np.int64)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances; by floating point where that is exact."""
    top = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if vectors.shape[1] * (2 * top) ** 2 < 1 << 53:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(1) for c in centroids], axis=1)


def scan(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cluster, squared distance and lower bound of the distance to all other centroids."""
    every = distances(vectors, centroids)
    cluster = every.argmin(axis=1)
    nearest = every[np.arange(len(every)), cluster]
    if len(centroids) == 1:
        return cluster, nearest, np.full(len(every), np.inf)
    second = np.partition(every, 1, axis=1)[:, 1]
    return cluster, nearest, np.sqrt(second.astype(np.float64)) * (1 - MARGIN)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much at most each cluster's vectors come nearer to any other moved centroid.

    ``radius`` is that of a sphere around the old centroid which holds the cluster's vectors.
    """
    a, b = old.astype(np.float64), new.astype(np.float64)
    move = np.sqrt(((b - a) ** 2).sum(1))
    middle = (a + b) / 2
    away = a[:, None] - middle[None]
    far = np.sqrt((away ** 2).sum(2))
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip((away * (b - a)[None]).sum(2) / (far * move), -1, 1))
        filled = np.arcsin(np.clip(radius[:, None] / far, 0, 1))
        nearer = move * np.cos(np.clip(angle - filled, 0, np.pi / 2))
    nearer = np.where(radius[:, None] >= far * (1 - MARGIN), move, nearer)
    nearer = np.where(move > 0, np.minimum(nearer + MARGIN * (1 + move), move * (1 + MARGIN)), 0.0)
    np.fill_diagonal(nearer, 0.0)
    return nearer.max(axis=1)


def half_gaps(centroids: np.ndarray) -> np.ndarray:
    """Half the distance from each centroid to the nearest other one."""
    gaps = np.sqrt(distances(centroids, centroids).astype(np.float64))
    np.fill_diagonal(gaps, np.inf)
    return gaps.min(axis=1) / 2 * (1 - MARGIN)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), -1)


def _state(batch: pa.RecordBatch, cluster, distance, lower, scanned) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        batch.column(0), batch.column(1), pa.array(cluster, pa.int32()),
        pa.array(distance, pa.int64()), pa.array(lower, pa.float64()), pa.array(scanned)],
        names=["vec_id", "vector", "cluster", "distance", "lower", "scanned"])


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with its cluster, from scratch."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield _state(batch, *scan(_matrix(batch.column(1)), centroids),
                             np.ones(len(batch), dtype=bool))

    return stored(vectors.select("vec_id", "vector").mapInArrow(place, _STATE), "assigned")


def reassign(state: DataFrame, centroids: np.ndarray, loose: np.ndarray) -> DataFrame:
    """Every vector with its cluster after the centroids moved; scans the ambiguous ones only."""
    half = half_gaps(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            values = _matrix(batch.column(1))
            cluster = batch.column(2).to_numpy().copy()
            distance = ((values - centroids[cluster]) ** 2).sum(axis=1)
            own = np.sqrt(distance.astype(np.float64)) * (1 + MARGIN)
            lower = np.maximum(batch.column(4).to_numpy() - loose[cluster],
                               2 * half[cluster] - own)
            ambiguous = own >= np.maximum(lower, half[cluster])
            at = np.flatnonzero(ambiguous)
            if len(at):
                cluster[at], distance[at], lower[at] = scan(values[at], centroids)
            yield _state(batch, cluster, distance, lower, ambiguous)

    return stored(state.mapInArrow(place, _STATE), "assigned")


def totals(state: DataFrame, size: int) -> dict[int, tuple[int, float, list[int]]]:
    """Per cluster: number of vectors, radius and component sums.  A row per cluster."""
    sums = [F.sum(F.get("vector", F.lit(d))).alias(f"s{d}") for d in range(size)]
    rows = state.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"), *sums).collect()
    return {r["cluster"]: (r["n"], float(np.sqrt(r["far"])), [r[f"s{d}"] for d in range(size)])
            for r in rows}


def cluster(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
            size: int = DIMENSIONS, seed: int = 2) -> DataFrame:
    """Every vector that takes part: vec_id, vector, cluster, distance, scanned,
    cluster_inertia, inertia, centroid (its components), centroid_sha256.

    ``distance`` is squared; ``scanned`` tells whether the last round had to scan the vector.
    """
    spark = embeddings.sparkSession
    vectors = usable(embeddings, scale, size)
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, vector array<int>, cluster int, distance long, scanned boolean, "
                "cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    state = assign(vectors, centroids)
    for _ in range(rounds):
        known, moved = totals(state, size), centroids.copy()
        radius = np.zeros(len(centroids))
        for c, (n, far, sums) in known.items():
            moved[c] = [s // n for s in sums]
            radius[c] = far * (1 + MARGIN)
        loose, centroids = loosening(centroids, moved, radius), moved
        state = reassign(state, centroids, loose)
    inertia = {r[0]: int(r[1]) for r in state.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    fits = {c: v if v < 1 << 63 else None for c, v in inertia.items()}
    whole = sum(inertia.values())
    whole = whole if whole < 1 << 63 else None
    named = [(c, fits[c], whole, centroids[c].tolist(), hashlib.sha256(
        ",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in sorted(inertia)]
    named = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, "
                                         "centroid array<long>, centroid_sha256 string")
    return state.drop("lower").join(F.broadcast(named), "cluster").select(
        "vec_id", "vector", "cluster", "distance", "scanned", "cluster_inertia", "inertia",
        "centroid", "centroid_sha256")


def digest(result: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return result.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                         "centroid_sha256")
