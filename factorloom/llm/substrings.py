"""Substring dedup: a count-min prefilter, then exact grouping of what it cannot rule out.

First pass: each partition adds its 50-word windows to a count-min sketch and sends it in
sparse form, cut into slices; slices are merged, and of the merged sketch two bits' worth of
information is needed: which cells reach two.  An estimate is never below the true count, so a
window that occurs twice always passes.  Second pass: windows estimated at two or more are
identified by a 96-bit BLAKE2 digest of their very words.  A partition decides by itself all
occurrences but those in the smallest document it has for a window, so a window that occurs in
a third of all documents sends one row per partition.

Nulls, empties and repeats: a null or empty text has no words; a null id counts as larger than
any other and its windows protect nothing; rows with equal ids do not remove each other's
words; equal rows have equal results.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factorloom.llm.frames import sized, stored
from factorloom.llm.text import BLANKS, Words, mix, pieces, windows

WIDTH = 50
DEPTH = 2
# The merged sketch is broadcast: DEPTH bits per cell, 64 MB at most.
MAX_CELL_BITS = 28
_SLICE_BITS = 20
# Text that is looked at in one go; its arrays take some twenty times as much.
PIECE_BYTES = 1 << 20
# The bitmap of affected documents: 8 MB.
MARK_BITS = 26
_NO_ID = np.iinfo(np.int64).max
_FOUND = "h1 long, h2 int, doc_id long, key long, place int, more array<int>"


def pack(cells: np.ndarray) -> bytes:
    """Ascending numbers as bytes: each gap in steps of 255, ended by a smaller byte."""
    gaps = np.diff(cells, prepend=0)
    steps = gaps // 255 + 1
    out = np.full(int(steps.sum()), 255, dtype=np.uint8)
    out[np.cumsum(steps) - 1] = gaps % 255
    return out.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, dtype=np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def cells_of(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each window in one row of the sketch."""
    salted = mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (row + 1) & 0xFFFFFFFFFFFFFFFF))
    return (salted >> np.uint64(64 - bits)).astype(np.int64)


def sketch(docs: DataFrame, bits: int, width: int) -> bytes:
    """The rows of the merged sketch, one after the other, as packed bits: does the cell
    reach two?"""
    slice_bits = min(bits, _SLICE_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush():
            if not held:
                return
            hashes = np.concatenate(held)
            held.clear()
            out: dict[str, list] = {"part": [], "one": [], "two": []}
            for row in range(DEPTH):
                cells, counts = np.unique(cells_of(hashes, row, bits), return_counts=True)
                cuts = np.flatnonzero(np.diff(cells >> slice_bits, prepend=-1))
                for a, b in zip(cuts, np.r_[cuts[1:], len(cells)]):
                    number = int(cells[a] >> slice_bits)
                    inner = cells[a:b] - (number << slice_bits)
                    out["part"].append(row << 32 | number)
                    out["one"].append(pack(inner))
                    out["two"].append(pack(inner[counts[a:b] > 1]))
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("part", pa.int64()), ("one", pa.binary()), ("two", pa.binary())]))

        for batch in batches:
            for a, b in pieces(batch.column(0), PIECE_BYTES):
                words = Words(batch.column(0).slice(a, b - a), BLANKS, lower=False)
                found = windows(words.hashes(), words.first, width)[1]
                if len(found):
                    held.append(found)
                if sum(map(len, held)) > 1 << 20:
                    yield from flush()
        yield from flush()
        pa.default_memory_pool().release_unused()

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        one = np.zeros(1 << slice_bits, dtype=bool)
        two = np.zeros(1 << slice_bits, dtype=bool)
        for ones, twos in zip(rows["one"], rows["two"]):
            cells = unpack(ones.as_py())
            two[cells[one[cells]]] = True
            one[cells] = True
            two[unpack(twos.as_py())] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()),
                         "bits": pa.array([np.packbits(two).tobytes()], pa.binary())})

    merged = (docs.select("text").mapInArrow(count, "part long, one binary, two binary")
              .groupBy("part").applyInArrow(merge, "part long, bits binary"))
    out = np.zeros((DEPTH, max(1, 1 << bits >> 3)), dtype=np.uint8)
    size = max(1, 1 << slice_bits >> 3)
    for row in merged.toLocalIterator():
        at = (row[0] & 0xFFFFFFFF) * size
        out[row[0] >> 32, at:at + size] = np.frombuffer(row[1], dtype=np.uint8)
    return out.tobytes()


def may_repeat(hashes: np.ndarray, merged: bytes, bits: int) -> np.ndarray:
    """The windows whose estimate reaches two."""
    passed = np.arange(len(hashes))
    merged = np.frombuffer(merged, dtype=np.uint8).reshape(DEPTH, -1)
    for row in range(DEPTH):
        cells = cells_of(hashes[passed], row, bits)
        passed = passed[merged[row, cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1 > 0]
    return passed


def _occurrences(docs: DataFrame, merged, bits: int, width: int) -> DataFrame:
    """Second pass.  With a ``place``: a window (its digest h1, h2) in the smallest document
    its task has for it.  With ``more``: places of a document already known to be removed;
    h1, h2 only spread those rows."""
    shared = docs.sparkSession.sparkContext.broadcast(merged)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush():
            if not held:
                return
            digests, ids, keys, places = (np.concatenate(x) for x in zip(*held))
            held.clear()
            h1, h2 = digests["h1"], digests["h2"]
            # by window, then document
            order = np.lexsort((ids, h2, h1))
            h1, h2, ids, keys, places = (x[order] for x in (h1, h2, ids, keys, places))
            new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            first = ids == ids[np.flatnonzero(new)][np.cumsum(new) - 1]
            yield rows(h1[first], h2[first], ids[first], keys[first], pa.array(places[first]),
                       pa.nulls(int(first.sum()), pa.list_(pa.int32())))
            ids, keys, places = ids[~first], keys[~first], places[~first]
            order = np.lexsort((places, keys, ids))
            ids, keys, places = ids[order], keys[order], places[order]
            heads = np.flatnonzero(np.r_[
                True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])][:len(ids)])
            yield rows(ids[heads], places[heads], ids[heads], keys[heads],
                       pa.nulls(len(heads), pa.int32()), pa.ListArray.from_arrays(
                           pa.array(np.r_[heads, len(ids)], pa.int32()), pa.array(places)))

        for batch in batches:
            for a, b in pieces(batch.column(1), PIECE_BYTES):
                words = Words(batch.column(1).slice(a, b - a), BLANKS, lower=False)
                starts, hashes = windows(words.hashes(), words.first, width)
                passed = starts[may_repeat(hashes, shared.value, bits)]
                if not len(passed):
                    continue
                joined, offsets = words.joined()
                view = memoryview(joined.tobytes())
                digests = b"".join(
                    hashlib.blake2b(view[x:y], digest_size=12).digest()
                    for x, y in zip(offsets[passed].tolist(), offsets[passed + width].tolist()))
                owner = np.searchsorted(words.first, passed, "right") - 1
                ids = batch.column(0).slice(a, b - a).fill_null(_NO_ID).to_numpy()
                keys = batch.column(2).slice(a, b - a).to_numpy()
                held.append((np.frombuffer(digests, dtype=[("h1", "<i8"), ("h2", "<i4")]),
                             ids[owner], keys[owner],
                             (passed - words.first[owner]).astype(np.int32)))
                if sum(len(x[0]) for x in held) > 1 << 18:
                    yield from flush()
        yield from flush()
        # an idle worker keeps nothing that the sorts to come could use
        pa.default_memory_pool().release_unused()

    def rows(h1, h2, ids, keys, place, more) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(h1), pa.array(h2), pa.array(ids), pa.array(keys), place, more],
            names=["h1", "h2", "doc_id", "key", "place", "more"])

    return docs.select("doc_id", "text", "key").mapInArrow(find, _FOUND)


def repeated_places(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, key, at): per document the start positions of the windows to be removed.

    ``docs`` has doc_id, text and key, which tells rows with the same id apart; a null id comes
    back as the largest long.
    """
    # a word and its blank take two bytes or more; six is usual
    bits = min(MAX_CELL_BITS, max(12, int(sized(docs, "text") // 3).bit_length()))
    found = _occurrences(docs, sketch(docs, bits, width), bits, width)
    # rows without a place are decided: they look no further than their own spread
    least = F.min("doc_id").over(Window.partitionBy(
        "h1", "h2", F.col("place").isNull()))
    return (found.withColumn("least", least).where("place is null or doc_id > least")
            .groupBy("doc_id", "key").agg(F.collect_list("place").alias("places"),
                                          F.flatten(F.collect_list("more")).alias("more"))
            .select("doc_id", "key", F.concat("places", "more").alias("at")))


def _marks(gone: DataFrame) -> bytes:
    """A bitmap of ``2 ** MARK_BITS`` bits, set at the marks of the documents in ``gone``."""
    rows = gone.select(_mark("doc_id", "key").alias("bit")).groupBy(
        F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    out = np.zeros((1 << MARK_BITS >> 15, 1 << 12), dtype=np.uint8)
    for bucket, bits in rows:
        out[bucket - 1, :len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return out.tobytes()


def _mark(doc_id, key) -> Column:
    return F.shiftrightunsigned(F.xxhash64(doc_id, key), 64 - MARK_BITS) + 1


def dedup(docs: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, kept.

    ``kept`` has the words that stay, joined by one space (null unless ``with_text``).  A word
    goes if a window of ``width`` words covers it whose words also start in a document with a
    smaller id; windows are judged on the input.  Only documents that a small bitmap marks
    as perhaps affected are joined with their windows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # with ids of their own, rows need no further key, which would be most of a window's bytes
    unique = docs.groupBy("doc_id").count().where("count > 1").isEmpty()
    docs = docs.withColumn("key", F.lit(0).cast("long") if unique else F.xxhash64("text"))
    gone = stored(repeated_places(docs, width), "places")
    shared = docs.sparkSession.sparkContext.broadcast(_marks(gone))
    docs = docs.withColumn("mark", _mark(F.coalesce("doc_id", F.lit(_NO_ID)), "key"))

    def marked(batch: pa.RecordBatch, column: int) -> np.ndarray:
        at = batch.column(column).to_numpy() - 1
        bits = np.frombuffer(shared.value, dtype=np.uint8)
        return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0

    def affected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(batch, 3))).select(["doc_id", "text", "key"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from finish(batch.filter(pa.array(~marked(batch, 2))), None)
        pa.default_memory_pool().release_unused()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from finish(batch, batch.column(2))

    def finish(batch: pa.RecordBatch, places: pa.Array | None) -> Iterator[pa.RecordBatch]:
        for a, b in pieces(batch.column(1), PIECE_BYTES):
            words = Words(batch.column(1).slice(a, b - a), BLANKS, lower=False)
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            if places is not None:
                at = places.slice(a, b - a)
                starts = at.flatten().to_numpy() + np.repeat(
                    words.first[:-1], at.value_lengths().fill_null(0).to_numpy())
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + width, -1)
            stay = np.cumsum(edge[:-1]) == 0
            joined, offsets = words.joined()
            left = joined[np.repeat(stay, np.diff(offsets))].tobytes()
            size = np.zeros(len(words) + 1, dtype=np.int64)
            np.cumsum(np.where(stay, np.diff(offsets), 0), out=size[1:])
            ends = size[words.first]
            kept = [left[x:max(x, y - 1)] for x, y in zip(ends[:-1], ends[1:])]
            removed = np.zeros(len(words) + 1, dtype=np.int64)
            np.cumsum(~stay, out=removed[1:])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a), pa.array(words.counts, pa.int64()),
                pa.array(np.diff(removed[words.first]), pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                pa.array(kept, pa.binary()).cast(pa.string()) if with_text
                else pa.nulls(b - a, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    out = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    places = gone.select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key"), "at")
    some = docs.mapInArrow(affected, "doc_id long, text string, key long")
    some = some.join(places, (F.coalesce(some["doc_id"], F.lit(_NO_ID)) == places["gone_id"])
                     & (some["key"] == places["gone_key"]), "left")
    return (docs.select("doc_id", "text", "mark").mapInArrow(others, out)
            .union(some.select("doc_id", "text", "at").mapInArrow(cut, out)))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return result.select("doc_id", "n_words", "n_removed", "kept_sha256")
