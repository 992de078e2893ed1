"""Benchmark decontamination with a positional inverted index of the training text.

The index is partitioned by documents: a *segment* is a run of documents read by one task, its
words are numbered through, and for each term of the segment one row stores the ordered
positions.  A search reads the rows of the query terms only, brings those of one segment
together, and intersects lists shifted by the term's place in the phrase, shortest list first.

Nulls, empties and repeats: a null or empty text has no words and never matches; a null id is
kept as it is; equal rows are separate documents with equal results; an item of the query set
with no word matches nothing, one with a null id marks words without being listed; an empty
table gives an empty result.  Other columns of the tables are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from factorloom.llm.frames import joined_sorted, sized, stored, task_id
from factorloom.llm.text import NON_ALNUM, Words, pieces

WINDOW = 13
_INDEX = T.StructType([
    T.StructField("segment", T.LongType()), T.StructField("term", T.LongType()),
    T.StructField("doc_id", T.LongType()), T.StructField("key", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("at", T.ArrayType(T.IntegerType()))])
_HITS = "segment long, start int, item_id long, low int, high int"


def build_index(docs: DataFrame, segment_bytes: int = 8 << 20) -> DataFrame:
    """The stored index of ``docs`` (doc_id, text).

    Rows with a term: ``at`` has the ordered positions of that term in the segment.  Rows
    without: one per document, ``at`` has its first position, ``key`` a hash of its text.
    Documents lie one position apart, so no phrase runs over a border.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for a, b in pieces(batch.column(1), segment_bytes):
                words = Words(batch.column(1).slice(a, b - a), NON_ALNUM, lower=True)
                n = b - a
                base = words.first[:-1] + np.arange(n)
                place = np.arange(len(words)) + np.repeat(np.arange(n), words.counts)
                terms = words.hashes()
                order = np.argsort(terms, kind="stable")
                terms = terms[order]
                heads = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]][:len(terms)])
                segment = (task_id() << 32) + number
                number += 1
                m = len(heads)
                at = pa.ListArray.from_arrays(
                    pa.array(np.r_[heads, np.arange(len(terms), len(terms) + n + 1)], pa.int32()),
                    pa.array(np.r_[place[order], base], pa.int32()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(m + n, segment), pa.int64()),
                    pa.concat_arrays([pa.array(terms[heads].view(np.int64), pa.int64()),
                                      pa.nulls(n, pa.int64())]),
                    pa.concat_arrays([pa.nulls(m, pa.int64()),
                                      batch.column(0).slice(a, n).cast(pa.int64())]),
                    pa.concat_arrays([pa.nulls(m, pa.int64()),
                                      batch.column(2).slice(a, n).cast(pa.int64())]),
                    pa.concat_arrays([pa.nulls(m, pa.int64()),
                                      pa.array(words.counts, pa.int64())]),
                    at], names=[f.name for f in _INDEX])

    return stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                              F.xxhash64("text").alias("key"))
                  .mapInArrow(index, _INDEX), "postings")


def directory(index: DataFrame) -> DataFrame:
    """The documents of an index: segment, first position, doc_id, n_words."""
    return index.where("term is null").select(
        "segment", F.col("at")[0].alias("start"), "doc_id", "key", "n_words")


def phrases_of(items: list[tuple[int, str | None]], window: int | None):
    """(terms, phrases, owners): the distinct query terms in order, each distinct phrase as
    places in them, and the items that hold it.  Plain values, for a broadcast."""
    words = Words(pa.array([t for _, t in items], pa.string()), NON_ALNUM, lower=True)
    hashes = words.hashes()
    terms = np.unique(hashes)
    ids = np.searchsorted(terms, hashes)
    seen: dict[tuple[int, ...], set] = {}
    for i, (item, _) in enumerate(items):
        a, b = int(words.first[i]), int(words.first[i + 1])
        size = b - a if window is None else min(window, b - a)
        for s in range(a, b - size + 1 if b > a else a):
            seen.setdefault(tuple(ids[s:s + size].tolist()), set()).add(item)
    return terms, list(seen), [sorted(v, key=lambda x: (x is None, x)) for v in seen.values()]


def _lists(rows: pa.Table, terms: np.ndarray) -> tuple[list[np.ndarray | None], np.ndarray]:
    """Of one segment: the position list of each query term, None where it does not occur,
    and the first positions of the documents."""
    rows = rows.combine_chunks()
    term, at = rows["term"], rows["at"]
    whole = term.is_null().to_numpy()
    slots = np.searchsorted(terms, term.fill_null(0).to_numpy().view(np.uint64))
    ends = np.cumsum(at.combine_chunks().value_lengths().to_numpy())
    values = at.combine_chunks().flatten().to_numpy()
    out: list[np.ndarray | None] = [None] * len(terms)
    for slot, a, b in zip(slots[~whole], np.r_[0, ends[:-1]][~whole], ends[~whole]):
        out[slot] = values[a:b]
    return out, np.sort(values[np.r_[0, ends[:-1]][whole]])


def _exact(lists: list, phrase: tuple[int, ...]) -> np.ndarray:
    """Positions where the phrase starts: shifted lists intersected from the rarest term on."""
    if any(lists[t] is None for t in phrase):
        return np.zeros(0, np.int64)
    order = sorted(range(len(phrase)), key=lambda j: len(lists[phrase[j]]))
    starts = lists[phrase[order[0]]] - order[0]
    for j in order[1:]:
        if not len(starts):
            break
        other = lists[phrase[j]]
        near = np.searchsorted(other, starts + j)
        near[near == len(other)] = 0
        starts = starts[other[near] == starts + j]
    return starts


def _near(lists: list, phrase: tuple[int, ...], within: int) -> np.ndarray:
    """Positions of query words from which ``within`` words on hold every word of the query."""
    terms = sorted(set(phrase), key=lambda t: 0 if lists[t] is None else len(lists[t]))
    if not terms or lists[terms[0]] is None:
        return np.zeros(0, np.int64)
    rare = lists[terms[0]]
    spots = np.unique(np.concatenate([lists[t] for t in terms]))
    after = np.searchsorted(rare, spots)
    spots = spots[(after < len(rare)) & (rare[np.minimum(after, len(rare) - 1)] - spots < within)]
    for t in terms:
        at = lists[t]
        after = np.searchsorted(at, spots)
        keep = after < len(at)
        keep[keep] = at[after[keep]] - spots[keep] < within
        spots = spots[keep]
    return spots


def _search(index: DataFrame, query: tuple, within: int | None) -> DataFrame:
    """Per segment and item, the merged position ranges of the matches and their document."""
    spark = index.sparkSession
    terms = spark.createDataFrame([(int(t),) for t in query[0].view(np.int64)], "term long")
    wanted = index.join(F.broadcast(terms), "term", "left_semi")
    shared = spark.sparkContext.broadcast(query)

    def match(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        known, phrases, owned = shared.value
        lists, base = _lists(rows, known)
        found: dict[int, list] = {}
        for phrase, owners in zip(phrases, owned):
            starts = (_exact(lists, phrase) if within is None
                      else _near(lists, phrase, within))
            if within is not None and len(starts):
                # the whole range has to lie in the document of its first word
                inside = np.searchsorted(base, starts, "right")
                border = np.r_[base, np.iinfo(np.int32).max][inside] - 1
                starts = starts[_near_ends(lists, phrase, starts) <= border]
            if len(starts):
                length = len(phrase) if within is None else 1
                for item in owners:
                    found.setdefault(item, []).append((starts, starts + length))
        out = []
        for item, spans in found.items():
            low = np.concatenate([s[0] for s in spans])
            high = np.concatenate([s[1] for s in spans])
            order = np.argsort(low, kind="stable")
            low, high = low[order], np.maximum.accumulate(high[order])
            heads = np.flatnonzero(np.r_[True, low[1:] > high[:-1]])
            ends = high[np.r_[heads[1:], len(high)] - 1]
            doc = base[np.searchsorted(base, low[heads], "right") - 1]
            out.append((doc, [item] * len(doc), low[heads] - doc, ends - doc))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [[], [], [], []]
        start, items, low, high = columns
        return pa.table({"segment": pa.array([key[0].as_py()] * len(start), pa.int64()),
                         "start": pa.array(start, pa.int32()),
                         "item_id": pa.array(list(items), pa.int64()),
                         "low": pa.array(low, pa.int32()), "high": pa.array(high, pa.int32())})

    marks = index.where("term is null")
    return (wanted.unionByName(marks).select("segment", "term", "at")
            .groupBy("segment").applyInArrow(match, _HITS))


def _near_ends(lists: list, phrase: tuple[int, ...], starts: np.ndarray) -> np.ndarray:
    """One past the last word needed to complete a proximity match from each start."""
    ends = starts
    for t in set(phrase):
        ends = np.maximum(ends, lists[t][np.searchsorted(lists[t], starts)])
    return ends + 1


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str | None]]]:
    """The query set in blocks of at most about ``block_bytes`` of text, whatever its size."""
    n = max(1, -(-sized(items, "text") // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        yield [(r[0], r[1]) for r in items.where(part == i).collect()]


def search(index: DataFrame, items: DataFrame, window: int | None = WINDOW,
           within: int | None = None, block_bytes: int = 4 << 20) -> DataFrame:
    """Matches of ``items`` (item_id, text) in an index: segment, start, item_id, low, high.

    ``window`` cuts an item into all its runs of that many words (None: the item is one
    phrase, as for proximity).  ``within`` asks for proximity in place of exact phrases: all
    words of the item within that many consecutive words of one document; the range is then
    the word where such a stretch starts.  Ranges of words count from the document's first.
    The query set is broadcast in blocks of bounded size.
    """
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    parts = [stored(_search(index, phrases_of(block, window), within), "matches")
             for block in _blocks(items, block_bytes) if block]
    if not parts:
        return index.sparkSession.createDataFrame([], _HITS)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  share: int = 20) -> DataFrame:
    """Per row of ``docs``: doc_id, key (of its text), n_words, n_hit, item_ids, contaminated.

    A word is hit if it lies in an occurrence of a window of an item; a document is
    contaminated if it has a hit and ``share`` times its hit words reach its words.
    """
    index = build_index(docs)
    found = search(index, items, window)
    before = Window.partitionBy("segment", "start").orderBy("low", "high").rowsBetween(
        Window.unboundedPreceding, -1)
    hits = (found.withColumn("seen", F.coalesce(F.max("high").over(before), F.lit(0)))
            .groupBy("segment", "start").agg(
                F.sum(F.greatest(F.lit(0), F.col("high") - F.greatest("low", "seen"))).alias("n"),
                F.collect_set("item_id").alias("items")))
    n_hit = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    return (directory(index).join(hits, ["segment", "start"], "left")
            .select("doc_id", "key", "n_words", n_hit.alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<long>")).alias("item_ids"))
            .withColumn("contaminated",
                        (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return result.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        joined_sorted(F.col("item_ids")).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; all columns, in order.

    Rows are recognised by their id and text: equal rows share one verdict.
    """
    bad = (contamination(docs, items).where("contaminated")
           .select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key")).distinct())
    here = docs["doc_id"].cast("long").eqNullSafe(bad["bad_id"])
    return docs.join(bad, here & (F.xxhash64(docs["text"]) == bad["bad_key"]), "left_anti")
