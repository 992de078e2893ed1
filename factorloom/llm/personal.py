"""Personal data: fixed patterns, and spans that a conditional random field adds.

The base spans are those of fixed patterns with a check of each match.  The model (``crf``) is
trained on a small labelled table and finds what the patterns do not: numbers without a country
code, mistyped or unusually grouped cards, addresses without a domain, account numbers.
It looks at the words with a digit or an at sign, in runs, by their shape and their neighbours.  A span
of the model that overlaps a base span is left out; base spans stay as they are.

Words, their marks and their places come from numpy over whole batches of texts; Python sees the
marked words only.  A pattern never starts over inside a run it has read, so a text of any length
and content takes linear time.

Nulls, empties and repeats: a null or empty text has no spans, and a null text stays null; a null
or repeated id is kept as it is, equal texts have equal spans.  Very long texts are read whole,
their chains too.  Equal scores go to the smaller state, so results do not vary.  Other columns are
kept, also those named like the added ones where other names are asked for.  An empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factorloom.llm import crf
from factorloom.llm.crf import Model
from factorloom.llm.labelled import KINDS as MODEL_KINDS
from factorloom.llm.labelled import labelled, unmark
from factorloom.llm.text import BLANKS, Words, buffer_of, pieces

KINDS = ("email", "ip", "card", "phone")
# The model is trained on this many labelled sentences at most.
MAX_LABELLED = 5_000

# The base patterns.  The optional part makes a run that does not match be read once.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPANS = "array<struct<rank:int,start:int,stop:int,kind:string>>"


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return sum(values[::2] + [v * 2 - 9 * (v > 4) for v in values[1::2]]) % 10 == 0


def _digits(match: str) -> str:
    return "".join(c for c in match if "0" <= c <= "9")


def _card(match: str) -> bool:
    digits = _digits(match)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) < 256


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(rank, start, stop, kind) of the base patterns, by kind, then place."""
    out = []
    if "@" in text:
        out += [(0, m.start(), m.end(), "email") for m in EMAIL.finditer(text) if m[1]]
    if "." in text:
        out += [(1, m.start(), m.end(), "ip") for m in IP.finditer(text)
                if m[1] and all(map(_small, m[0].split(".")))]
    out += [(2, m.start(), m.end(), "card") for m in CARD.finditer(text) if _card(m[0])]
    if "+" in text:
        out += [(3, m.start(), m.end(), "phone") for m in PHONE.finditer(text)
                if 9 <= len(_digits(m[0])) <= 15]
    return out


def example(sentence: str) -> tuple[list[str], list[int]]:
    """The words of a labelled sentence and their states."""
    text, spans = unmark(sentence)
    words, states = [], []
    for m in _WORD.finditer(text):
        words.append(m[0])
        states.append(0)
        for kind, start, stop in spans:
            if m.start() < stop and m.end() > start and crf.is_marked(m[0]):
                states[-1] = 1 + 2 * MODEL_KINDS.index(kind) + (m.start() > start)
    return words, states


def fit(sentences: DataFrame, most: int = MAX_LABELLED) -> Model:
    """The model of a labelled table (sentence), spans marked as in ``labelled``.

    Of more than ``most`` sentences those with the least hashes are taken.
    """
    rows = sentences.where("sentence is not null").orderBy(
        F.xxhash64("sentence"), "sentence").limit(most).select("sentence").collect()
    return crf.train([example(r[0]) for r in rows], MODEL_KINDS)


def _chain_spans(words: list[str], starts: list[int], states: list[int]):
    """(kind number, start, stop) of the spans in a chain; places count code points."""
    out, i = [], 0
    while i < len(states):
        j = i + 1
        if states[i]:
            while j < len(states) and states[j] and states[j] % 2 == 0:
                j += 1
            a, b = crf.core(words[i])[0], crf.core(words[j - 1])[1]
            if starts[j - 1] + b > starts[i] + a:
                out.append(((states[i] - 1) // 2, starts[i] + a, starts[j - 1] + b))
        i = j
    return out


def model_spans(model: Model, column: pa.Array) -> list[list[tuple[int, int, int, str]]]:
    """The model's spans in each text of a batch: (rank, start, stop, kind)."""
    words = Words(column, BLANKS, lower=False)
    out: list[list[tuple[int, int, int, str]]] = [[] for _ in range(len(column))]
    if not len(words):
        return out
    data = words.data
    hits = np.r_[0, np.cumsum(((data >= 0x30) & (data <= 0x39)) | (data == 0x40))]
    at = np.flatnonzero(hits[words.ends] > hits[words.starts])
    if not len(at):
        return out
    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    owner = np.searchsorted(words.first, at, "right") - 1
    place = points[words.starts[at]] - points[buffer_of(column)[1][owner]]

    def word(i: int, text: int) -> str | None:
        if not words.first[text] <= i < words.first[text + 1]:
            return None
        return data[words.starts[i]:words.ends[i]].tobytes().decode()

    new = np.r_[True, (np.diff(at) > 1) | (np.diff(owner) > 0)]
    heads = np.flatnonzero(new).tolist()
    chains, texts = [], []
    for a, b in zip(heads, [*heads[1:], len(at)]):
        text = int(owner[a])
        own = [word(i, text) for i in range(int(at[a]) - 1, int(at[b - 1]) + 2)]
        chains.append(crf.run_features(own[1:-1], own[0], own[-1]))
        texts.append(own[1:-1])
    for a, b, own, states in zip(heads, [*heads[1:], len(at)], texts, crf.decode(model, chains)):
        if any(states):
            out[int(owner[a])] += [
                (len(KINDS) + kind, start, stop, "crf_" + model.kinds[kind])
                for kind, start, stop in _chain_spans(own, place[a:b].tolist(), states)]
    return out


def find(model: Model, column: pa.Array):
    """For each text of a batch its base spans and all its spans, by kind, then place."""
    added = model_spans(model, column)
    for text, more in zip(column.to_pylist(), added):
        base = base_spans(text or "")
        places = sorted((s[1], s[2]) for s in base)
        latest = np.maximum.accumulate([p[1] for p in places]) if places else np.zeros(0)
        begins = [p[0] for p in places]
        kept = []
        for span in more:
            # of the base spans that begin before this one ends, none may end after it begins
            before = int(np.searchsorted(begins, span[2]))
            if not before or latest[before - 1] <= span[1]:
                kept.append(span)
        yield base, sorted(base + kept)


def _mapped(docs: DataFrame, model: Model, schema: StructType,
            change: Callable[[pa.RecordBatch, list], pa.RecordBatch]) -> DataFrame:
    """``change`` of each batch and its spans.  The model, of a bounded table, is broadcast."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(at)):
                part = batch.slice(a, b - a)
                yield change(part, list(find(shared.value, part.column(at))))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(work, schema)


_ARROW = pa.list_(pa.struct([("rank", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
                             ("kind", pa.string())]))


def scan(docs: DataFrame, model: Model | None = None,
         names: tuple[str, str] = ("base", "spans")) -> DataFrame:
    """``docs`` with columns ``base`` and ``spans``, or as named: arrays of (rank, start, stop,
    kind) by kind, then place, the second with those of the model."""
    model = fit(labelled(docs.sparkSession)) if model is None else model
    both = StructType.fromDDL(f"`{names[0]}` {_SPANS}, `{names[1]}` {_SPANS}")
    schema = StructType(docs.withColumn("text", F.col("text").cast("string")).schema.fields
                        + both.fields)

    def add(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        columns = [pa.array([[dict(zip(("rank", "start", "stop", "kind"), s)) for s in own[i]]
                             for own in found], _ARROW) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    return _mapped(docs, model, schema, add)


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every span of its ``text`` replaced by its kind in brackets; all rows and
    columns.  Spans that touch or overlap become one mark, of the first; ``n_chars``, where
    there is one, is the new length."""
    model = fit(labelled(docs.sparkSession)) if model is None else model
    schema = docs.withColumn("text", F.col("text").cast("string")).schema
    at = docs.columns.index("text")

    def mark(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        texts = []
        for text, (_, spans) in zip(part.column(at).to_pylist(), found):
            out, end = [], 0
            for _, start, stop, kind in sorted(spans, key=lambda s: (s[1], s[0])):
                if not out or start > end:
                    out += [text[end:start], f"[{kind.removeprefix('crf_').upper()}]"]
                end = max(end, stop)
            texts.append("".join([*out, text[end:]]) if out else text)
        columns = [pa.array(texts, pa.string()) if i == at else c
                   for i, c in enumerate(part.columns)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    clean = _mapped(docs, model, schema, mark)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType))
    return clean


def described(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the contract."""
    found = scan(docs.select(F.col("doc_id").cast("long"), "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, kind))).cast("long")
              .alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(described(F.col("base")), 256)
                        .alias("base_sha256"), described(F.col("spans")).alias("spans"))
