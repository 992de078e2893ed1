"""Variable-capacity best-fit packing of documents into sequences of several permitted lengths.

A document longer than the largest length is cut into full pieces, each a sequence of its own,
and a rest.  Rests and shorter documents are dealt into groups of bounded size; a group is
packed longest first: into the open bin that it leaves the least room in, else into a new bin of
the length with the least cost for each token it can expect to hold, judged by what is still to
be placed.  In the end each bin shrinks to the least length that holds its contents.

Lengths are in characters by default; any integer column expression can be given.

``sequences`` builds them: texts are cut where they are read, pieces meet their places, and the
pieces of one sequence, never more than the largest length, are joined in order.

Nulls, empties and repeats: a null or empty text has one piece of length 0, in no bin; a null
or repeated id is kept as it is, rows are told apart by a number of their own, equal rows by
their places only.  Very long texts are pieces of the largest length.  Only id and text are read,
other columns may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.llm.frames import stored
from factorloom.llm.text import pieces

CAPACITIES = (2048, 4096, 8192, 16384)
OVERHEAD = 64
GROUP_ROWS = 50_000


def linear_cost(capacity: int, overhead: int = OVERHEAD) -> float:
    """A sequence costs its length and a fixed overhead."""
    return capacity + overhead


def pack(lengths: np.ndarray, capacities: tuple[int, ...],
         cost: Callable[[int], float] = linear_cost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, capacity) of each item; items have lengths from 1 to the largest capacity."""
    sizes = sorted(capacities)
    price = {c: cost(c) for c in sizes}
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order]
    after = np.r_[np.cumsum(falling[::-1])[::-1], 0]
    # for room r, the first place in the falling order whose item fits
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []
    rooms: list[tuple[int, int]] = []
    least = int(falling[-1]) if len(falling) else 0
    rising = -falling
    for i, (item, size) in enumerate(zip(order.tolist(), falling.tolist())):
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            def per_token(c: int) -> tuple[float, int]:
                fits = int(np.searchsorted(rising, -(c - size), "left"))
                return price[c] / (size + min(c - size, int(after[max(i + 1, fits)]))), -c

            room = min((c for c in sizes if c >= size), key=per_token)
            number = len(used)
            used.append(0)
        bins[item], offsets[item] = number, used[number]
        used[number] += size
        room -= size
        if room >= least:
            bisect.insort(rooms, (room, number))
    fitting = np.array(sizes)[np.searchsorted(sizes, used)] if used else np.zeros(0, np.int64)
    return bins, offsets, fitting[bins]


def pack_documents(docs: DataFrame, length: Column | None = None,
                   capacities: tuple[int, ...] = CAPACITIES,
                   cost: Callable[[int], float] = linear_cost,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin_group, bin, capacity, offset.

    ``start`` is the piece's place in its document, ``offset`` its place in the sequence
    (bin_group, bin).  Full pieces have a negative bin_group.  A group holds about
    ``group_rows`` pieces, spread evenly over all groups by row number.
    """
    return _placed(docs, length, capacities, cost, group_rows).drop("key")


def _key() -> Column:
    """A row's id and text, as one number."""
    return F.xxhash64(F.lit(31), F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _placed(docs: DataFrame, length: Column | None, capacities: tuple[int, ...],
            cost: Callable[[int], float], group_rows: int) -> DataFrame:
    """The pieces of ``pack_documents``, each with the ``key`` of its row."""
    most = max(capacities)
    length = F.length(F.col("text").cast("string")) if length is None else length
    rows = stored(docs.select(
        F.col("doc_id").cast("long"), _key().alias("key"),
        F.coalesce(length.cast("long"), F.lit(0)).alias("size"),
        F.monotonically_increasing_id().alias("row")), "lengths")
    full = rows.where(F.col("size") >= most).select(
        "doc_id", "key", "row", F.explode(F.sequence(
            F.lit(0), (F.floor(F.col("size") / most) - 1).cast("int"))).alias("piece"))
    full = full.select(
        "doc_id", "key", "piece", (F.col("piece").cast("long") * most).alias("start"),
        F.lit(most).cast("long").alias("length"), (-1 - F.col("row")).alias("bin_group"),
        F.col("piece").cast("long").alias("bin"), F.lit(most).cast("long").alias("capacity"),
        F.lit(0).cast("long").alias("offset"))
    rest = rows.select(
        "doc_id", "key", "row", F.floor(F.col("size") / most).cast("int").alias("piece"),
        (F.floor(F.col("size") / most) * most).alias("start"),
        (F.col("size") % most).alias("length"))
    nothing = rest.where("length = 0 and piece = 0").select(
        "doc_id", "key", "piece", "start", "length",
        *[F.lit(None).cast("long").alias(c) for c in ("bin_group", "bin", "capacity", "offset")])
    rest = rest.where("length > 0")
    groups = max(1, -(-rest.count() // group_rows))

    def fill(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending")])
        bins, offsets, sizes = pack(table["length"].to_numpy(), capacities, cost)
        return pa.table({
            **{c: table[c] for c in ("doc_id", "key", "piece", "start", "length")},
            "bin_group": pa.array(np.full(len(table), key[0].as_py()), pa.int64()),
            "bin": pa.array(bins, pa.int64()), "capacity": pa.array(sizes, pa.int64()),
            "offset": pa.array(offsets, pa.int64())})

    packed = (rest.withColumn("bin_group", F.pmod(F.xxhash64("row"), F.lit(groups)))
              .groupBy("bin_group").applyInArrow(fill, full.schema))
    return packed.unionByName(full).unionByName(nothing)


def _cut(docs: DataFrame, most: int) -> DataFrame:
    """(key, piece, part): every text in pieces of ``most`` characters, equal rows once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                keys, numbers, parts = [], [], []
                for key, text in zip(batch.column(0)[a:b].to_pylist(),
                                     batch.column(1)[a:b].to_pylist()):
                    for i, start in enumerate(range(0, len(text or ""), most)):
                        keys.append(key)
                        numbers.append(i)
                        parts.append(text[start:start + most])
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.int64()), pa.array(numbers, pa.int32()),
                    pa.array(parts, pa.string())], names=["key", "piece", "part"])

    return (docs.select(_key().alias("key"), F.col("text").cast("string"))
            .mapInArrow(cut, "key long, piece int, part string").dropDuplicates(["key", "piece"]))


def sequences(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES,
              cost: Callable[[int], float] = linear_cost,
              group_rows: int = GROUP_ROWS) -> DataFrame:
    """The packed sequences, lengths in characters.

    A row per sequence: bin_group, bin, capacity, length, padding, doc_ids, starts, offsets,
    lengths, text.  The arrays have an entry per piece, in order: whose it is, where it begins in
    its document and in the sequence, and how long it is.  ``padding`` is the room left.  A
    document without text is a row of its own, without a sequence.  No group is larger than the
    largest capacity.
    """
    placed = _placed(docs, None, capacities, cost, group_rows)
    rows = placed.where("bin_group is not null").join(_cut(docs, max(capacities)),
                                                      ["key", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "part")))
    packed = rows.groupBy("bin_group", "bin", "capacity").agg(parts.alias("parts")).select(
        "bin_group", "bin", "capacity",
        F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["length"]).alias("length"),
        F.col("parts.doc_id").alias("doc_ids"), F.col("parts.start").alias("starts"),
        F.col("parts.offset").alias("offsets"), F.col("parts.length").alias("lengths"),
        F.array_join("parts.part", "").alias("text"))
    zero = F.array(F.lit(0).cast("long"))
    alone = placed.where("bin_group is null").select(
        "bin_group", "bin", "capacity", "length", F.array("doc_id").alias("doc_ids"),
        zero.alias("starts"), zero.alias("offsets"), zero.alias("lengths"),
        F.lit("").alias("text"))
    every = packed.unionByName(alone)
    return every.select("bin_group", "bin", "capacity", "length",
                        (F.col("capacity") - F.col("length")).alias("padding"), "doc_ids",
                        "starts", "offsets", "lengths", "text")
