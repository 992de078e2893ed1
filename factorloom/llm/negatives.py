"""Hard-negative mining with exact integer products in a residue number system.

Vectors are quantised to integers.  For a block of anchors and a batch of rows the matrix of inner
products is multiplied once per prime: residues are centred, so with primes below 1024 a sum over
64 dimensions stays below 2^24 and float32 holds it exactly.  Chinese remaindering (mixed radix
digits, centred as well) gives the signed score back; as many primes are taken as the largest
possible score of the block and the batch needs.

Two passes read the stored vectors, neither shuffles them.  The first finds each anchor's best rows
of its own label, the *positives*.  The second knows those scores, and so for every positive the
window of scores a negative may have; it keeps the best rows of other labels inside each window.
Tasks send on no more rows for a positive than are asked for.  Anchors are broadcast in blocks of
``BLOCK_BYTES``, however many there are.

Nulls, empties and repeats: a row with a null label, a vector that is null or empty or that holds a
null or non-finite component takes no part, nor does one whose scores might pass 2^58 (its size
times the square of its largest component); a row with a null id is a candidate that loses ties,
never an anchor; rows that repeat an id are anchors and candidates each; equal scores go by id.
Rows are compared with those of the same length.  Very long vectors are multiplied 64 dimensions
at a time.  Only the three columns named are read, others may have any name.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factorloom.llm.frames import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# A negative's score in percent of its positive's: from the first to the second.
LEAST, MOST = 80, 100
DIMENSIONS = 64
BLOCK_BYTES = 4 << 20
TILE = 1 << 20
LIMIT = 1 << 58
_NONE = np.int64(-(1 << 62))
_NO_ID = np.iinfo(np.int64).max


def primes(n: int, below: int = 1024) -> tuple[int, ...]:
    """The ``n`` largest primes below a bound."""
    found = (p for p in range(below - 1, 1, -1) if all(p % q for q in range(2, int(p ** .5) + 1)))
    return tuple(p for p, _ in zip(found, range(n)))


PRIMES = primes(6)


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """float32 integers below 2^24, reduced modulo ``p`` to about p / 2 either side of 0."""
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))


def residues(values: np.ndarray, p: int) -> np.ndarray:
    rest = values % p
    return np.where(rest > p // 2, rest - p, rest).astype(np.float32)


def needed(bound: int) -> tuple[int, ...]:
    """The fewest primes whose product tells all integers up to ``bound`` in size apart."""
    product = 1
    for i, p in enumerate(PRIMES):
        product *= p
        if product > 2 * bound + 1:
            return PRIMES[:i + 1]
    raise OverflowError(f"scores of {bound} need more than {len(PRIMES)} primes")


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    size = left.shape[1]
    bound = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * size
    moduli, digits = needed(bound), []
    for p in moduli:
        a, b = residues(left, p), residues(right, p)
        rest = np.zeros((len(left), len(right)), dtype=np.float32)
        for d in range(0, size, DIMENSIONS):
            rest = centred(rest + centred(
                a[:, d:d + DIMENSIONS] @ b[:, d:d + DIMENSIONS].T, p), p)
        base = 1
        for digit, q in zip(digits, moduli):
            weight = base % p
            rest = rest - centred(digit * np.float32(weight - p * (weight > p // 2)), p)
            base *= q
        back = pow(base, -1, p)
        digits.append(centred(centred(rest, p) * np.float32(back - p * (back > p // 2)), p))
    total, base = np.zeros((len(left), len(right)), dtype=np.int64), 1
    for digit, p in zip(digits, moduli):
        total += digit.astype(np.int64) * base
        base *= p
    half = base // 2
    total[total > half] -= base
    total[total < -half] += base
    return total


class Best:
    """The ``k`` best (score, id) of each of several owners, fed a tile of scores at a time."""

    def __init__(self, owners: int, k: int):
        self.k = k
        self.bar = np.full(owners, _NONE)
        self.owner = np.zeros(0, np.int64)
        self.score, self.vec_id, self.row = (np.zeros(0, np.int64) for _ in range(3))

    def offer(self, first: int, scores: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        """Scores of owners ``first``.. with a batch of rows; ``_NONE`` where there is none."""
        n, width = scores.shape
        bar = self.bar[first:first + n]
        new = bar == _NONE
        if width > self.k and new.any():
            bar[new] = np.partition(scores[new], width - self.k, axis=1)[:, width - self.k]
        owner, at = np.nonzero((scores >= bar[:, None]) & (scores != _NONE))
        if not len(owner):
            return
        owners = np.r_[self.owner, owner + first]
        values = np.r_[self.score, scores[owner, at]]
        ids, rows = np.r_[self.vec_id, vec_id[at]], np.r_[self.row, row[at]]
        order = np.lexsort((ids, -values, owners))
        heads = np.flatnonzero(np.r_[True, np.diff(owners[order]) != 0])
        rank = np.arange(len(order)) - np.repeat(heads, np.diff(np.r_[heads, len(order)]))
        last = order[rank == self.k - 1]
        self.bar[owners[last]] = values[last]
        keep = order[rank < self.k]
        self.owner, self.score = owners[keep], values[keep]
        self.vec_id, self.row = ids[keep], rows[keep]


def least_score(positive: np.ndarray) -> np.ndarray:
    """The least score a negative of this positive may have; no product, so no overflow."""
    hundredth, rest = np.divmod(positive, 100)
    return hundredth * LEAST - (-rest * LEAST // 100)


def most_score(positive: np.ndarray) -> np.ndarray:
    hundredth, rest = np.divmod(positive, 100)
    return hundredth * MOST + rest * MOST // 100


def usable(vectors: DataFrame, scale: int = SCALE, label: Column | None = None) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part, components as floor(scale * x).

    ``row`` numbers the rows; they are stored, so that it stays the same.
    """
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda v: v * scale)
    unfit = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    largest = F.array_max(F.transform("x", lambda v: F.abs(F.floor(v)).cast("double")))
    label = F.col("label") if label is None else label
    return stored(
        vectors.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"),
                       scaled.alias("x"))
        .where(F.col("label").isNotNull() & (F.size("x") > 0))
        .select("*", unfit.alias("unfit"), largest.alias("largest"))
        .where(~F.col("unfit")
               & (F.size("x") * F.col("largest") * F.col("largest") < float(LIMIT)))
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "label",
                F.transform("x", lambda v: F.floor(v).cast("int")).alias("vector")), "vectors")


# vec_id and label of a batch, and its vectors by length
def _batches(batches: Iterator[pa.RecordBatch], rows: int = 4096):
    for whole in batches:
        for start in range(0, len(whole), rows):
            batch = whole.slice(start, rows)
            ids = batch.column(1).fill_null(_NO_ID).to_numpy()
            sizes = batch.column(3).value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                own = own[np.argsort(ids[own], kind="stable")]
                vectors = batch.column(3).take(pa.array(own)).flatten().to_numpy()
                yield (size, batch.column(0).to_numpy()[own], ids[own],
                       batch.column(2).to_numpy()[own],
                       vectors.reshape(len(own), size).astype(np.int64))


def _tiles(anchors: int, width: int):
    step = max(1, TILE // max(width, 1))
    return [(a, min(a + step, anchors)) for a in range(0, anchors, step)]


def _by_length(block: dict) -> dict[int, np.ndarray]:
    sizes = np.array([len(v) for v in block["vector"]])
    return {s: np.flatnonzero(sizes == s) for s in np.unique(sizes).tolist()}


def _emit(best: Best, owner_columns: dict[str, np.ndarray], names: tuple[str, ...]):
    ids = best.vec_id
    columns = [pa.array(c[best.owner]) for c in owner_columns.values()]
    columns += [pa.array(ids, mask=ids == _NO_ID), pa.array(best.score)]
    return pa.RecordBatch.from_arrays(columns, names=[*owner_columns, *names])


def positives(vectors: DataFrame, block: dict, k: int = POSITIVES) -> DataFrame:
    """(anchor_row, slot, positive_id, positive_score): the best rows of the anchor's label."""
    shared = vectors.sparkSession.sparkContext.broadcast(block)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        held = {s: (own, np.stack([block["vector"][i] for i in own]), Best(len(own), k))
                for s, own in _by_length(block).items()}
        for size, row, ids, label, values in _batches(batches):
            if size not in held:
                continue
            own, matrix, best = held[size]
            for a, b in _tiles(len(own), len(row)):
                at = own[a:b]
                fits = ((block["label"][at][:, None] == label) & (block["row"][at][:, None] != row))
                best.offer(a, np.where(fits, products(matrix[a:b], values), _NONE), ids, row)
        for own, _, best in held.values():
            yield _emit(best, {"anchor_row": block["row"][own]}, ("positive_id", "positive_score"))

    found = vectors.mapInArrow(match, "anchor_row long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_row").orderBy(
        F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    return found.withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= k)


def negatives(vectors: DataFrame, block: dict, pairs: dict[str, np.ndarray],
              k: int = NEGATIVES) -> DataFrame:
    """The best rows of other labels in the window of each positive in ``pairs`` (anchor, slot,
    positive_id, positive_score; by anchor), ``anchor`` being a place in ``block``."""
    shared = vectors.sparkSession.sparkContext.broadcast((block, pairs))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pairs = shared.value
        size_of = np.array([len(v) for v in block["vector"]])[pairs["anchor"]]
        held = {}
        for s in np.unique(size_of).tolist():
            mine = np.flatnonzero(size_of == s)
            # windows of one anchor follow one another
            own, first = np.unique(pairs["anchor"][mine], return_index=True)
            high = pairs["positive_score"][mine]
            held[s] = (mine, own, np.r_[first, len(mine)], least_score(high), most_score(high),
                       np.stack([block["vector"][i] for i in own]), Best(len(mine), k))
        for size, row, ids, label, values in _batches(batches):
            if size not in held:
                continue
            mine, own, first, low, high, matrix, best = held[size]
            for a, b in _tiles(len(own), len(row)):
                scores = products(matrix[a:b], values)
                scores[block["label"][own[a:b]][:, None] == label] = _NONE
                owners = np.repeat(np.arange(b - a), np.diff(first[a:b + 1]))
                for x, y in _tiles(len(owners), len(row)):
                    part = scores[owners[x:y]]
                    w = slice(first[a] + x, first[a] + y)
                    outside = (part < low[w, None]) | (part > high[w, None])
                    part[outside] = _NONE
                    best.offer(first[a] + x, part, ids, row)
        for mine, _, _, _, _, _, best in held.values():
            at = pairs["anchor"][mine]
            yield _emit(best, {"anchor_row": block["row"][at], "anchor_id": block["vec_id"][at],
                               **{c: pairs[c][mine] for c in ("slot", "positive_id", "positive_score")}},
                        ("negative_id", "negative_score"))

    return vectors.mapInArrow(
        match, "anchor_row long, anchor_id long, slot long, positive_id long, positive_score long, "
               "negative_id long, negative_score long")


def _block(rows: list) -> dict:
    return {"row": np.array([r[0] for r in rows], np.int64),
            "vec_id": np.array([r[1] for r in rows], np.int64),
            "label": np.array([r[2] for r in rows], np.int64),
            "vector": [np.array(r[3], np.int64) for r in rows]}


def mine(vectors: DataFrame, anchors: DataFrame, positive_count: int = POSITIVES,
         negative_count: int = NEGATIVES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_row, anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` and ``anchors`` have the rows of ``usable``, the anchors among the vectors.
    """
    spark = vectors.sparkSession
    cells = anchors.agg(F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()[0]
    blocks = max(1, -(-8 * cells // block_bytes))
    part = F.pmod(F.xxhash64(F.lit(41), "row"), F.lit(blocks))
    found = []
    for i in range(blocks):
        rows = anchors.where(part == i).select("row", "vec_id", "label", "vector").collect()
        if not rows:
            continue
        block = _block(rows)
        best = positives(vectors, block, positive_count).collect()
        place = {row: i for i, row in enumerate(block["row"].tolist())}
        best = sorted((place[r["anchor_row"]], r["slot"], r["positive_id"], r["positive_score"])
                      for r in best)
        if best:
            pairs = {"anchor": np.array([b[0] for b in best]),
                     "slot": np.array([b[1] for b in best], np.int64),
                     "positive_id": np.array([_NO_ID if b[2] is None else b[2] for b in best]),
                     "positive_score": np.array([b[3] for b in best], np.int64)}
            found.append(stored(negatives(vectors, block, pairs, negative_count), "negatives"))
    if not found:
        return spark.createDataFrame([], "anchor_row long, anchor_id long, positive_id long, "
                                         "rank int, negative_id long, positive_score long, "
                                         "negative_score long")
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    order = Window.partitionBy("anchor_row", "slot").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    return (every.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= negative_count)
            .select("anchor_row", "anchor_id",
                    F.nullif("positive_id", F.lit(int(_NO_ID))).alias("positive_id"), "rank",
                    "negative_id", "positive_score", "negative_score"))


def mislabelled() -> Column:
    """The label of the contract: every seventh id has the next one."""
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id").cast("long") % 7 == 0, (label + 1) % 10).otherwise(label)


def hard_negatives(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """The rows whose id is divisible by ``every`` as anchors, against all rows."""
    vectors = usable(embeddings, label=mislabelled())
    return mine(vectors, vectors.where(F.col("vec_id") % every == 0))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return result.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                         "negative_score")
