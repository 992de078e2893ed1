"""Near-duplicates by HyperMinHash: compressed minima, banding, estimate, exact check.

For each of ``REGISTERS`` buckets a document keeps the least hash of its shingles, compressed to
the number of leading zeros and the mantissa bits that follow: 16 bits instead of 64.  Three
registers make a band; documents that agree on a band are candidates.  Two equal registers
may stem from different minima, so the share of equal registers is corrected by the rate of
such collisions; a candidate pair far below the threshold is dropped on that estimate, every
other one is checked on its full sets.

Sets that are equal are one *class* from the start and take part once.  In a busy band all
classes are first compared with its most central one, a number of pairs linear in its size;
those that the links have not connected are then compared in tasks of bounded size that
return links between connected parts, never pairs.

A pair at the threshold agrees on none of the 42 bands with probability 1e-10, and falls below the
estimate's margin with 1e-7.

Nulls, empties and repeats: a null or empty text has no shingles, its component is its own
id; a null id belongs to the component of its set, which is null if no id is in it; rows that
repeat an id with other texts are separate documents.  Very long texts are read whole; ``thin``
keeps other columns of any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.llm.frames import components, fresh, stored
from factorloom.llm.text import BLANKS, Words, mix, pieces, powers, windows

SHINGLE = 5
THRESHOLD = 75
REGISTERS = 126
BAND = 3
MANTISSA = 10
# A pair whose estimate is this far below the threshold is no candidate: five deviations.
MARGIN = 0.2
# Texts that one side of a comparison task holds.
CHUNK_BYTES = 8 << 20

# The blanks of the word rule, in a pattern.
_BLANKS = r"\x20\x09-\x0D"
_SEEDS = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(words: Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and the n + 1 offsets."""
    hashes = words.hashes()
    starts, found = windows(hashes, words.first, width)
    cuts = np.searchsorted(starts, words.first)
    base = powers(np.uint64(0xA0761D6478BD642F), width + 1)
    out, sizes = [], np.zeros(len(words.first), dtype=np.int64)
    for i, n in enumerate(words.counts):
        if n >= width:
            own = np.sort(found[cuts[i]:cuts[i + 1]])
            own = own[np.r_[True, own[1:] != own[:-1]]]
        elif n:
            few = hashes[words.first[i]:words.first[i + 1]]
            own = mix(np.array([np.sum(few * base[:n], dtype=np.uint64) + np.uint64(n)]))
        else:
            continue
        out.append(own)
        sizes[i + 1] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.cumsum(sizes)


def compress(minima: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa bits of 64-bit values, as 16-bit registers."""
    fraction, exponent = np.frexp((minima >> np.uint64(11)).astype(np.float64))
    zeros = np.where(fraction > 0, 53 - exponent, 53)
    tail = np.where(fraction > 0, (fraction * 2 - 1) * (1 << MANTISSA), 0)
    return (zeros << MANTISSA | tail.astype(np.int64)).astype(np.uint16)


def registers(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of registers per text; rows of empty texts are zero."""
    out = np.zeros((len(offsets) - 1, REGISTERS), dtype=np.uint16)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        heads = offsets[full]
        for j in range(REGISTERS):
            spread = (sets ^ _SEEDS[2 * j]) * (_SEEDS[2 * j + 1] | np.uint64(1))
            out[full, j] = compress(np.minimum.reduceat(spread, heads))
    return out


def collision_rate(n: float, m: float) -> float:
    """The chance that registers of disjoint sets of these sizes are equal."""
    edges = np.concatenate([[0.0]] + [
        2.0 ** -(z + 1) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA))
        for z in range(53, -1, -1)] + [[1.0]])

    def chances(size):
        with np.errstate(divide="ignore"):
            return -np.diff(np.exp(size * np.log1p(-edges)))

    return float(np.sum(chances(n) * chances(m)))


# By the bit length of the set size; sets at the threshold have sizes within 4/3.
_RATES = np.array([0.0] + [collision_rate(2.0 ** b, 2.0 ** b) for b in range(40)])


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Jaccard estimates of register rows, corrected for accidental collisions."""
    rate = _RATES[np.minimum(np.log2(np.maximum(n, 1)).astype(int) + 1, len(_RATES) - 1)]
    return ((a == b).mean(axis=1) - rate) / (1 - rate)


def _profiles(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), n, the digest of the set (c1, c2) and its registers."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1), 1 << 19):
                sets, offsets = shingles(
                    Words(batch.column(1).slice(a, b - a), BLANKS, lower=True))
                view = memoryview(sets.tobytes())
                digests = np.frombuffer(b"".join(
                    hashlib.blake2b(view[8 * x:8 * y], digest_size=16).digest()
                    for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())),
                    dtype=np.int64).reshape(-1, 2)
                rows = registers(sets, offsets)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                    pa.array([r.tobytes() for r in rows], pa.binary())],
                    names=["doc_id", "key", "n", "c1", "c2", "registers"])

    return stored(docs.mapInArrow(
        profile, "doc_id long, key long, n long, c1 long, c2 long, registers binary"), "profiles")


def _bands(nodes: DataFrame) -> DataFrame:
    """(band, node) for every band of every class; the band number is part of the value."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()),
                                 dtype=np.uint16).reshape(-1, REGISTERS).astype(np.int64)
            bands = np.repeat(np.arange(REGISTERS // BAND)[None], len(rows), axis=0)
            for j in range(BAND):
                bands = bands << 16 | rows[:, j::BAND]
            yield pa.RecordBatch.from_arrays([
                pa.array(bands.ravel()),
                pa.array(np.repeat(batch.column(0).to_numpy(), REGISTERS // BAND))],
                names=["band", "node"])

    return nodes.select("node", "registers").mapInArrow(cut, "band long, node long")


def _confirm(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.stack([batch.column(4).to_numpy(), batch.column(5).to_numpy()])
            rows = [np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint16)
                    .reshape(-1, REGISTERS) for i in (6, 7)]
            near = 100 * n.min(axis=0) >= threshold * n.max(axis=0)
            near &= estimate(rows[0], rows[1], n.max(axis=0)) >= threshold / 100 - MARGIN
            batch = batch.filter(pa.array(near))
            keep = np.zeros(len(batch), dtype=bool)
            # both columns have rows in common pieces: cut by the longer side
            for a, b in pieces(batch.column(2)):
                left, right = (shingles(Words(batch.column(i).slice(a, b - a), BLANKS, True))
                               for i in (2, 3))
                for i in range(b - a):
                    x = left[0][left[1][i]:left[1][i + 1]]
                    y = right[0][right[1][i]:right[1][i + 1]]
                    both = np.sort(np.concatenate([x, y]))
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    keep[a + i] = 100 * common >= threshold * (len(both) - common)
            out = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([out.column(0), out.column(1)], names=["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"),
                        F.col("n").alias("na"), F.col("registers").alias("ra"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"),
                         F.col("n").alias("nb"), F.col("registers").alias("rb"))
    joined = pairs.join(left, "a").join(right, "b").select(
        "a", "b", "ta", "tb", "na", "nb", "ra", "rb")
    return stored(joined.mapInArrow(check, "a long, b long"), "near-links")


def _with_component(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that are not connected yet."""
    a = comps.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = comps.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))


def _own_shingles(texts: DataFrame) -> DataFrame:
    """(node, own): how many shingles of each class no other class of ``texts`` has.

    One aggregate over the shingles, which combines on the map side: a shingle of a third of all
    classes is a row per map task.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                sets, offsets = shingles(Words(batch.column(1).slice(a, b - a), BLANKS, True))
                nodes = np.repeat(batch.column(0).slice(a, b - a).to_numpy(), np.diff(offsets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes), pa.array(sets.view(np.int64))], names=["node", "shingle"])

    rows = texts.select("node", "text").mapInArrow(explode, "node long, shingle long")
    return (rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last"))
            .where("node = last").groupBy("node").agg(F.count(F.lit(1)).alias("own")))


def _may_link(a: Column, b: Column, threshold: int) -> Column:
    """Whether two classes (n, shared) may reach the threshold: they have no more shingles in
    common than either shares with anyone."""
    most = F.least(a["shared"], b["shared"])
    return F.lit(100) * most >= F.lit(threshold) * (a["n"] + b["n"] - most)


def _with_leaders(members: DataFrame) -> DataFrame:
    """``members`` (band, at, weight) of the bands with two or more, and each band's leader: the
    class of the greatest weight."""
    leaders = members.groupBy("band").agg(
        F.max(F.struct("weight", (-F.col("at.node")).alias("order"), "at")).alias("top"),
        F.count(F.lit(1)).alias("size"))
    return members.join(leaders.where("size > 1").select(
        "band", F.col("top.weight").alias("leader_weight"), F.col("top.at").alias("leader")),
        "band").drop("weight")


def _rest_links(members: DataFrame, comps: DataFrame, texts: DataFrame,
                threshold: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Links (a, b) between classes of one band that the leaders have not connected.

    In each band the largest connected part is set against all others.  Bands with the same
    largest part are one task, cut on either side into chunks of bounded bytes; a task
    compares full sets over an index of their shingles, and returns one link at most from a
    class to each connected part, never the pairs.
    """
    parts = members.join(comps, F.col("at.node") == comps["id"], "left").select(
        "band", F.col("at.node").alias("node"), F.coalesce("component", "at.node").alias("part"))
    sizes = parts.groupBy("band", "part").agg(F.count(F.lit(1)).alias("size"))
    major = (sizes.groupBy("band").agg(F.max(F.struct("size", "part")).alias("top"),
                                       F.count(F.lit(1)).alias("parts"))
             .where("parts > 1").select("band", F.col("top.part").alias("major")))
    apart = stored(parts.join(major, "band").select("major", "node", "part").distinct()
                   .join(texts.select("node", "text"), "node"), "apart")
    size = F.octet_length("text")
    chunks = apart.groupBy("major").agg(
        F.ceil(F.sum(size) / chunk_bytes).cast("int").alias("all_chunks"),
        F.ceil(F.sum(F.when(F.col("part") != F.col("major"), size)) / chunk_bytes).cast("int")
        .alias("odd_chunks"))
    dealt = apart.join(chunks, "major")

    def side(rows: DataFrame, odd: bool) -> DataFrame:
        own, other = ("odd_chunks", "all_chunks") if odd else ("all_chunks", "odd_chunks")
        mine = F.pmod(F.xxhash64("node"), F.col(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return rows.select("major", (mine if odd else theirs).alias("i"),
                           (theirs if odd else mine).alias("j"), F.lit(odd).alias("odd"),
                           "node", "part", "text")

    def match(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        odd = rows["odd"].to_numpy()
        left, right = rows.filter(pa.array(odd)), rows.filter(pa.array(~odd))
        ours, theirs = (shingles(Words(x["text"].combine_chunks(), BLANKS, True))
                        if len(x) else (np.zeros(0, np.uint64), np.zeros(1, np.int64))
                        for x in (left, right))
        owner = np.repeat(np.arange(len(right)), np.diff(theirs[1]))
        order = np.argsort(theirs[0], kind="stable")
        known, owner = theirs[0][order], owner[order]
        n, part = np.diff(theirs[1]), right["part"].to_numpy()
        node = right["node"].to_numpy()
        a, b = [], []
        for row in range(len(left)):
            own = ours[0][ours[1][row]:ours[1][row + 1]]
            low, high = np.searchsorted(known, own), np.searchsorted(known, own, "right")
            size = high - low
            at = np.repeat(low - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            common = np.bincount(owner[at], minlength=len(right))
            near = np.flatnonzero((100 * common >= threshold * (len(own) + n - common))
                                  & (part != left["part"][row].as_py()))
            near = near[np.unique(part[near], return_index=True)[1]]
            a += [left["node"][row].as_py()] * len(near)
            b += node[near].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    both = side(dealt.where("part <> major"), True).union(side(dealt, False))
    return stored(both.groupBy("major", "i", "j").applyInArrow(match, "a long, b long"),
                  "near-links")


def link(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, key, n_shingles, part, component_id, kept.

    ``component_id`` is the least id reachable over pairs with 100 * |A and B| >= threshold *
    |A or B|; ``kept`` marks the rows that have it; ``key`` is a hash of the text; ``part`` is a
    number of the group, whatever ids its rows have, and null without shingles.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = docs.withColumn("key", F.xxhash64("text"))
    rows = _profiles(docs)
    nodes = stored(
        rows.where("n > 0").groupBy("c1", "c2").agg(
            F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key")).alias("head"),
            F.first("n").alias("n"), F.first("registers").alias("registers"))
        .select("c1", "c2", F.col("head.doc_id").alias("least"), F.col("head.key").alias("key"),
                "n", "registers", F.monotonically_increasing_id().alias("node")), "classes")
    bands = _bands(nodes)
    busy = bands.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(bands.join(busy, "band"), "members")
    # the more classes share bands with one, the nearer it is to the centre of its cloud
    weights = members.groupBy("node").agg(F.sum("size").alias("weight"))
    heads = weights.join(nodes, "node").select(
        "node", "weight", "least", F.col("key").alias("head_key"), "n", "registers")
    texts = stored(
        docs.join(heads, docs["doc_id"].eqNullSafe(heads["least"])
                  & (docs["key"] == heads["head_key"]))
        .select("node", "weight", "text", "n", "registers").dropDuplicates(["node"]), "near-texts")
    # a text that is mostly its own reaches the threshold with no other
    shared = F.col("n") - F.coalesce("own", F.lit(0))
    able = texts.select("node", "n", "weight").join(_own_shingles(texts), "node", "left").select(
        "node", "weight", F.struct("node", "n", shared.alias("shared")).alias("at")).where(
        F.lit(100) * F.col("at.shared") >= F.lit(threshold) * F.col("at.n"))
    members = stored(_with_leaders(
        members.join(able, "node").select("band", "at", "weight")), "led")

    stars = stored(members.where("at.node <> leader.node")
                   .where(_may_link(F.col("at"), F.col("leader"), threshold))
                   .groupBy(F.col("at.node").alias("a"), F.col("leader.node").alias("b"))
                   .agg(F.max("leader_weight").alias("weight")), "stars")
    best = stars.groupBy("a").agg(F.max_by("b", "weight").alias("b"))
    links = _confirm(best, texts, threshold)
    links = links.unionByName(
        _confirm(_with_component(stars, components(links)), texts, threshold))
    comps = components(links)
    comps = components(links.unionByName(_rest_links(members, comps, texts, threshold)))

    groups = nodes.join(comps, nodes["node"] == comps["id"], "left").select(
        "c1", "c2", "least", F.coalesce("component", "node").alias("part"))
    first = groups.groupBy("part").agg(F.min("least").alias("component_id"))
    named = groups.join(first, "part").select("c1", "c2", "part", "component_id")
    out = rows.join(named, ["c1", "c2"], "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("part")).alias("part"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return result.select("doc_id", "n_shingles", "component_id", "kept")


def thin(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates; all columns, in order.

    The row with the smallest id stays, null ids last, of equal ids that with the smallest hash
    of its text, of equal rows any one.  Rows without words stay.
    """
    key, one = fresh(docs, "row_key"), fresh(docs, "row_id")
    heads = (link(docs, threshold).where(F.col("part").isNotNull()).groupBy("part").agg(
        F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key")).alias("head"))
        .select(F.col("head.doc_id").alias(one), F.col("head.key").alias(key)))
    text = F.col("text").cast("string")
    worded = F.coalesce(text.rlike(f"[^{_BLANKS}]"), F.lit(False))
    own = docs.where(worded).withColumns(
        {key: F.xxhash64(text), one: F.col("doc_id").cast("long")})
    left, right = own.alias("l"), heads.alias("r")
    kept = left.join(right, F.col(f"l.{one}").eqNullSafe(F.col(f"r.{one}"))
                     & (F.col(f"l.{key}") == F.col(f"r.{key}")), "left_semi")
    return kept.dropDuplicates([one, key]).select(*docs.columns).unionByName(
        docs.where(~worded))
