"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Word and word-pair counts, hashed into ``2 ** bits`` buckets, give a generative model of the
target text (a bounded sample of labelled good documents) and one of the raw text (every
document).  A document's log weight is its mean log ratio of the two per n-gram, times
``strength``, so that length neither helps nor hurts.  The documents with the largest log weight
plus Gumbel noise are an exact sample without replacement in proportion to the weights.

Copies: each document has ``MINIMA`` least shingle hashes, and how many rows share the one of
rank ``SHARED`` is the size of its group of copies or near-copies.  In the raw model a group counts
as one document, or as one share of the rows if that is more; the shares, ``groups`` of them, are an
argument, and bound what is collected.

How many documents are drawn comes from the labelled ones, each text once: of those, as many stay
as are good, and k is the number of all documents whose noisy weight is above theirs; the k
largest are the sample.  A ``share`` asked for sets k directly.
A fitted document is weighed there by the target model without itself, as one that is not
labelled is.  Rows without labels, however many, move no cut.

Very long texts are read whole, in pieces of a batch; other columns of any name are kept.
Nulls, empties and repeats: a null or empty text has log weight 0; a null id takes part as it
is; the noise hangs on id and text, so equal rows share one verdict; labels with a null id or
quality are skipped, of repeated labels the lowest quality counts.  Without labelled documents
of both qualities every row is kept.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.llm.frames import fresh, stored
from factorloom.llm.text import BLANKS, Words, mix, pieces, windows

BITS = 16
STRENGTH = 500.0
# The target model is fitted on this many labelled documents at most.
MAX_TARGET = 20_000
# Least hashes of a document, the rank among their numbers of rows, words of a shingle.
MINIMA = 16
SHARED = 5
SHINGLE = 5
GROUPS = 1 << 16
_PART = 1 << 12
# Counts of the raw model are whole multiples of 1 / _UNIT: sums do not hang on their order.
_UNIT = 1 << 20
_SEEDS = mix(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bucket and row of every word and word pair of a piece of a batch."""
    words = Words(column, BLANKS, lower=True)
    return _features(words, words.hashes(), len(column), bits)


def _features(words: Words, singles: np.ndarray, n: int, bits: int
              ) -> tuple[np.ndarray, np.ndarray, int]:
    starts, pairs = windows(singles, words.first, 2)
    owner = np.repeat(np.arange(n), words.counts)
    shift = np.uint64(64 - bits)
    return (np.concatenate([singles >> shift, pairs >> shift]).astype(np.int64),
            np.concatenate([owner, owner[starts]]), n)


def minima(words: Words, singles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have words, and a row of ``MINIMA`` least shingle hashes for each.

    A text of fewer words than a shingle has is one shingle.
    """
    counts = words.counts
    full = np.flatnonzero(counts)
    out = np.zeros((len(counts), MINIMA), dtype=np.int64)
    for width in range(1, SHINGLE + 1):
        own = np.flatnonzero(counts == width if width < SHINGLE else counts >= width)
        if len(own):
            starts, found = windows(singles, words.first, width)
            inside = np.zeros(len(counts), dtype=bool)
            inside[own] = True
            owner = np.searchsorted(words.first, starts, "right") - 1
            found, owner = found[inside[owner]], owner[inside[owner]]
            heads = np.searchsorted(owner, own)
            for j in range(MINIMA):
                spread = (found ^ _SEEDS[2 * j]) * (_SEEDS[2 * j + 1] | np.uint64(1))
                out[own, j] = np.minimum.reduceat(spread, heads).view(np.int64)
    return full, out[full]


def shared_minima(docs: DataFrame, groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray, float]:
    """Least hashes that more rows share than a group may count for, ascending, their numbers
    of rows, and what a group may count for: ``MINIMA * GROUPS`` hashes at most."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                words = Words(batch.column(0).slice(a, b - a), BLANKS, lower=True)
                values, n = np.unique(minima(words, words.hashes())[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n, pa.int64())],
                                                 names=["least", "n"])

    counted = stored(docs.select(F.col("text").cast("string"))
                     .mapInArrow(least, "least long, n long")
                     .groupBy("least").agg(F.sum("n").alias("n")), "minima")
    rows = (counted.agg(F.sum("n")).first()[0] or 0) / MINIMA
    most = max(1.0, rows / groups)
    found = counted.where(F.col("n") > most).toArrow()
    values, n = (found.column(c).to_numpy() for c in ("least", "n"))
    order = np.argsort(values)
    return values[order], n[order], most


def group_sizes(least: np.ndarray, values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per row of ``least``, the ``SHARED``-th largest of the numbers of rows that share one."""
    if not len(values):
        return np.ones(len(least))
    at = np.minimum(np.searchsorted(values, least), len(values) - 1)
    return np.sort(np.where(values[at] == least, n[at], 1), axis=1)[:, -SHARED]


def target_sample(labels: DataFrame, most: int = MAX_TARGET) -> DataFrame:
    """At most ``most`` ids of good documents, drawn by a hash of the id."""
    good = (labels.where("doc_id is not null and quality is not null")
            .groupBy(F.col("doc_id").cast("long").alias("good_id"))
            .agg(F.min("quality").alias("q")).where("q = 1").select("good_id"))
    return good.orderBy(F.xxhash64(F.lit(5), "good_id"), "good_id").limit(most)


def _flagged(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, good) of ``docs``: whether the target model is fitted on the row."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.join(F.broadcast(sample), F.col("doc_id") == F.col("good_id"), "left").select(
        "doc_id", "text", F.col("good_id").isNotNull().alias("good"))


def models(docs: DataFrame, sample: DataFrame, bits: int = BITS,
           groups: int = GROUPS) -> np.ndarray:
    """Two rows of ``2 ** bits`` n-gram counts: of the raw and of the target text.

    Raw counts cover every document, copies together as one.  Each task sends its counts in
    parts of fixed size, so the summed models have the same size whatever the input.
    """
    size = 1 << bits
    shared = docs.sparkSession.sparkContext.broadcast(shared_minima(docs, groups))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size), dtype=np.int64)
        values, rows, most = shared.value
        for batch in batches:
            good = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in pieces(batch.column(0)):
                words = Words(batch.column(0).slice(a, b - a), BLANKS, lower=True)
                singles = words.hashes()
                buckets, owner, _ = _features(words, singles, b - a, bits)
                full, least = minima(words, singles)
                part = np.zeros(b - a)
                part[full] = np.round(_UNIT * np.minimum(
                    most / group_sizes(least, values, rows), 1.0))
                sums[0] += np.bincount(buckets, part[owner], size).astype(np.int64)
                if good[a:b].any():
                    sums[1] += np.bincount(buckets[good[a:b][owner]], minlength=size)
        step = min(_PART, size)
        for part in range(size // step):
            cut = slice(part * step, (part + 1) * step)
            if sums[:, cut].any():
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()),
                    "raw": pa.array([sums[0, cut].tobytes()], pa.binary()),
                    "target": pa.array([sums[1, cut].tobytes()], pa.binary())})

    def add(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        def total(name: str) -> bytes:
            return np.sum([np.frombuffer(x.as_py(), dtype=np.int64) for x in rows[name]],
                          axis=0).tobytes()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "raw": pa.array([total("raw")], pa.binary()),
                         "target": pa.array([total("target")], pa.binary())})

    kind = "part int, raw binary, target binary"
    flagged = _flagged(docs, sample).select("text", "good")
    model = np.zeros((2, size))
    for row in flagged.mapInArrow(count, kind).groupBy("part").applyInArrow(add, kind).collect():
        raw = np.frombuffer(row[1], dtype=np.int64)
        cut = slice(row[0] * len(raw), (row[0] + 1) * len(raw))
        model[0, cut] = raw / _UNIT
        model[1, cut] = np.frombuffer(row[2], dtype=np.int64)
    return model


def smoothed(model: np.ndarray) -> np.ndarray:
    """Log shares of the buckets, one count added to each."""
    return np.log(model + 1) - np.log(model.sum(axis=-1, keepdims=True) + model.shape[-1])


def log_ratios(docs: DataFrame, sample: DataFrame, bits: int = BITS) -> np.ndarray | None:
    """Per bucket, the log ratio of the target and the raw model; None without a target."""
    raw, target = models(docs, sample, bits)
    return smoothed(target) - smoothed(raw) if target.any() else None


def weights(docs: DataFrame, sample: DataFrame, model: np.ndarray, bits: int = BITS,
            strength: float = STRENGTH, seed: int = 17) -> DataFrame:
    """doc_id, key (of id and text), text_key, n_grams, log_weight, own_weight, sample_key.

    ``own_weight`` is the log weight under a target model without the row itself, and
    ``sample_key`` the log weight plus noise.
    """
    size = 1 << bits
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = smoothed(shared.value[0]), shared.value[1]
        ratios, whole = smoothed(target) - raw, target.sum()
        if not whole:
            ratios = np.zeros(size)
        for batch in batches:
            good = batch.column(4).to_numpy(zero_copy_only=False)
            for a, b in pieces(batch.column(1)):
                buckets, owner, n = features(batch.column(1).slice(a, b - a), bits)
                count = np.bincount(owner, minlength=n)
                total = np.bincount(owner, weights=ratios[buckets], minlength=n)
                fitted = good[a:b]
                mine = fitted[owner]
                at, times = np.unique(owner[mine] * size + buckets[mine], return_counts=True)
                row, bucket = at // size, at % size
                others = (np.log(target[bucket] - times + 1)
                          - np.log(whole - count[row] + size) - raw[bucket])
                own = np.where(fitted, np.bincount(row, times * others, n), total)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, n), batch.column(2).slice(a, n),
                    batch.column(3).slice(a, n), pa.array(count, pa.int64()),
                    *[pa.array(strength * x / np.maximum(count, 1), pa.float64())
                      for x in (total, own)]],
                    names=["doc_id", "key", "text_key", "n_grams", "log_weight", "own_weight"])

    return (_flagged(docs, sample)
        .select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"),
                F.xxhash64("text").alias("text_key"), "good")
        .mapInArrow(weigh, "doc_id long, key long, text_key long, n_grams long, "
                           "log_weight double, own_weight double")
        .withColumn("sample_key", F.col("log_weight") + noise(seed)))


def noise(seed: int) -> Column:
    """Gumbel noise by ``key``."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "key"), 11) + 0.5) / F.lit(2.0 ** 53)
    return -F.log(-F.log(uniform))


def labelled_cut(scored: DataFrame, labels: DataFrame, seed: int) -> float | None:
    """The sample key from which as many labelled texts stay as are good; None if all are.

    It lies halfway between the last text that stays and the next one.
    """
    each = (labels.where("doc_id is not null and quality is not null")
            .groupBy(F.col("doc_id").cast("long").alias("label_id"))
            .agg(F.min("quality").alias("quality")))
    known = scored.where("n_grams > 0").join(each, F.col("doc_id") == F.col("label_id"))
    known = stored(known.groupBy("text_key").agg(
        F.min("quality").alias("quality"),
        F.min(F.struct("doc_id", F.col("own_weight") + noise(seed))).alias("first"))
        .select("quality", F.col("first.col2").alias("v")), "labelled")
    n, good = known.agg(F.count("v"), F.count_if(F.col("quality") == 1)).first()
    if not 0 < good < n:
        return None
    last = kth_largest(known, "v", good)
    following = known.where(F.col("v") < last).agg(F.max("v")).first()[0]
    return last if following is None else (last + following) / 2


def kth_largest(values: DataFrame, column: str, k: int, bins: int = 4096) -> float | None:
    """The exact k-th largest value, by counting in ever finer bins; None if k exceeds them."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    if low is None:
        return None
    rest = values.select(F.col(column).alias("v"))
    while True:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            return high
        number = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))
        counts = {r[0]: (r[1], r[2], r[3]) for r in rest.groupBy(number.alias("bin")).agg(
            F.count("v"), F.min("v"), F.max("v")).collect()}
        for b in sorted(counts, reverse=True):
            n, least, most = counts[b]
            if k <= n:
                break
            k -= n
        else:
            return None
        rest, low, high = rest.where(number == b), least, most
        if n <= 10_000:
            return rest.orderBy(F.desc("v")).limit(k).agg(F.min("v")).first()[0]


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None,
             bits: int = BITS, strength: float = STRENGTH, seed: int = 17,
             groups: int = GROUPS) -> DataFrame:
    """Every row of ``docs``: doc_id, key, n_grams, log_weight, sample_key, kept.

    Keeps a ``share`` of the documents, or by default what the labelled ones' cut keeps.
    """
    sample = stored(target_sample(labels), "target")
    model = models(docs, sample, bits, groups)
    scored = stored(weights(docs, sample, model, bits, strength, seed), "weights")
    least, none = None, False
    if model[1].any():
        if share is None:
            least = labelled_cut(scored, labels, seed)
        else:
            n = scored.count()
            k = round(share * n)
            least = kth_largest(scored, "sample_key", k) if 0 < k < n else None
            none = k <= 0
    kept = F.lit(not none) if least is None else F.col("sample_key") >= F.lit(least)
    return scored.drop("text_key", "own_weight").withColumn("kept", kept)


def keep_sample(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """The kept rows of ``docs``, all columns."""
    key = fresh(docs, "row_key")
    bad = resample(docs, labels, share).where("not kept").select(
        F.col("key").alias("bad_key"), F.col("doc_id").alias("bad_id")).distinct()
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"),
                                            F.col("text").cast("string")))
    return keyed.join(bad, (keyed[key] == bad["bad_key"]) & keyed["doc_id"].cast("long")
                      .eqNullSafe(bad["bad_id"]), "left_anti").select(
        *[keyed[c] for c in docs.columns])


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select("doc_id", "n_grams", F.round("log_weight", 6).alias("log_weight"), "kept")
