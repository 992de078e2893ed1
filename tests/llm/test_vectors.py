"""Hard negatives and clustering against plain integer versions, on edge cases."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from factorloom.llm import clusters, negatives

# clashing names of work columns
SCHEMA = ("vec_id long, embedding array<double>, label int, row long, x int, vector string, "
          "cluster int, distance string, score double, slot int")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "v", 3, "d", 4.0, 5) for r in rows], SCHEMA)


def vectors(seed, n, size, copies=0):
    """Loose clouds; the first vector ``copies`` times over under other ids."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, .3) for _ in range(size)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, .1) for c in centres[i % 6]], rng.randrange(4))
            for i in range(n)]
    return rows + [(n + i, rows[0][1], i % 3) for i in range(copies)]


EDGES = [(None, [.5] * 8, 1), (200, [.5] * 8, 1), (200, [.5] * 8, 1), (201, None, 1),
         (202, [.5] * 7 + [None], 1), (203, [.5] * 7 + [float("nan")], 2),
         (204, [.5] * 7 + [float("inf")], 2), (205, [.4] * 8, None), (206, [], 1),
         (300, [.5] * 5, 0), (301, [.4] * 5, 1), (302, [.6] * 5, 0), (-100, [.45] * 8, 2),
         (400, [0.0] * 8, 1), (500, [-.5] * 8, 1), (207, [1e300] * 8, 1)]


def brute_negatives(rows):
    own = []
    for i, x, label in rows:
        if label is None or not x or any(v is None or not math.isfinite(v) for v in x):
            continue
        q = [math.floor(256 * v) for v in x]
        if len(q) * max(abs(v) for v in q) ** 2 >= negatives.LIMIT:
            continue
        own.append((i, q, (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for a, (i, q, label) in enumerate(own):
        if i is None or i % 100:
            continue
        scored = sorted(
            ((-sum(u * v for u, v in zip(q, p)), j is None, j, other)
             for b, (j, p, other) in enumerate(own) if b != a and len(p) == len(q)),
            key=lambda s: (s[0], s[1], s[2] or 0))
        for s, _, j, _ in [s for s in scored if s[3] == label][:5]:
            fit = [n for n in scored if n[3] != label and -80 * s <= -100 * n[0] <= -100 * s]
            out += [(i, j, r, n[2], -s, -n[0]) for r, n in enumerate(fit[:5], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 22, 256])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block_bytes):
    rows = vectors(5, 330, 8, copies=70) + EDGES
    mine = negatives.usable(table(spark, rows).repartition(5), label=negatives.mislabelled())
    found = negatives.digest(negatives.mine(
        mine, mine.where("vec_id % 100 = 0"), block_bytes=block_bytes))
    assert sorted(map(tuple, found.collect()), key=repr) == brute_negatives(rows)


def test_hard_negatives_of_an_empty_table(spark):
    assert negatives.digest(negatives.hard_negatives(table(spark, []))).collect() == []
    only = negatives.hard_negatives(table(spark, [(100, [.1, .2], 1)]))
    assert negatives.digest(only).collect() == []


@pytest.mark.parametrize("size", [1, 64, 200, 1000])
@pytest.mark.parametrize("top", [1, 135, 5000, 1 << 23])
def test_products_are_exact(size, top):
    rng = np.random.default_rng(size + top)
    if size * top ** 2 >= negatives.LIMIT:
        top = int(math.isqrt(negatives.LIMIT // size)) - 1
    a, b = rng.integers(-top, top, (7, size), endpoint=True), rng.integers(
        -top, top, (9, size), endpoint=True)
    a[0], b[0], b[1] = top, top, -top
    assert (negatives.products(a, b) == a @ b.T).all()


def test_primes_and_windows_of_scores():
    assert negatives.PRIMES == (1021, 1019, 1013, 1009, 997, 991)
    p = np.arange(-350, 350)
    low, high = negatives.least_score(p), negatives.most_score(p)
    assert (100 * low >= 80 * p).all() and (100 * (low - 1) < 80 * p).all()
    assert (100 * high <= 100 * p).all() and (100 * (high + 1) > 100 * p).all()


def brute_clusters(rows, size, k, rounds):
    own = [(i, [math.floor(256 * v) for v in x]) for i, x, _ in rows
           if x is not None and len(x) == size
           and not any(v is None or not math.isfinite(v) or abs(256 * v) >= clusters.LIMIT
                       for v in x)]

    def key(row):
        own_hash = hashlib.sha256(f"2:{row[0]}".encode()).hexdigest()
        return row[0] is None, own_hash if row[0] is not None else "", row[1]

    centres = [list(v) for _, v in sorted(own, key=key)[:k]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
                for _, v in own]

    for _ in range(rounds):
        at = [n for _, n in place()]
        for n in set(at):
            members = [v for (_, v), m in zip(own, at) if m == n]
            centres[n] = [sum(c) // len(members) for c in zip(*members)]
    ends = place()
    whole = sum(d for d, _ in ends)
    per = {n: sum(d for d, m in ends if m == n) for _, n in ends}
    return sorted([(i, n, d, per[n], whole, hashlib.sha256(
        ",".join(map(str, centres[n])).encode()).hexdigest())
        for (i, _), (d, n) in zip(own, ends)], key=repr)


@pytest.mark.parametrize("k", [1, 4, 12, 1000])
def test_clusters_equal_brute_force(spark, k):
    rows = vectors(9, 160, 8, copies=60) + EDGES
    found = clusters.digest(clusters.cluster(table(spark, rows).repartition(3), k=k, size=8))
    assert sorted(map(tuple, found.collect()), key=repr) == brute_clusters(rows, 8, k, 5)


def test_clusters_of_an_empty_table(spark):
    assert clusters.digest(clusters.cluster(table(spark, EDGES))).collect() == []


def test_bounds_spare_scans_on_clouds(spark):
    rows = vectors(3, 1200, 8)
    result = clusters.cluster(table(spark, rows), k=6, size=8, rounds=4)
    assert result.where("scanned").count() < 0.5 * len(rows)


def test_loosening_is_sound_and_less_than_the_full_move():
    rng = np.random.default_rng(1)
    spared = 0
    for _ in range(60):
        old = rng.integers(-200, 200, (5, 6))
        new = old + rng.integers(-40, 40, old.shape)
        radius = rng.uniform(0, 150, 5)
        loose = clusters.loosening(old, new, radius)
        full = np.sqrt(((new - old) ** 2).sum(1))
        for i in range(5):
            way = rng.normal(size=(4000, 6))
            way *= (radius[i] * rng.uniform(0, 1, 4000) ** .1 / np.linalg.norm(way, axis=1))[:, None]
            x = old[i] + way
            before = np.linalg.norm(x[:, None] - old[None], axis=2)
            after = np.linalg.norm(x[:, None] - new[None], axis=2)
            others = np.arange(5) != i
            assert (before - after)[:, others].max() <= loose[i]
            assert loose[i] <= full[others].max() * (1 + 1e-6)
            spared += loose[i] < 0.9 * full[others].max()
    assert spared > 100
