"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

Places of matches come from splitting a text at its matches: pieces and matches alternate, so
their lengths add up to the places.  A candidate string is a maximal run of one character
class.  A window slides over it; symbol counts are kept from step to step, and so is the sum of
c * log2(c) over the counts, which changes by table entries for the one symbol that comes in and
the one that goes out.  Entropy is log2(window) minus that sum over the window, so the largest
entropy is where the sum is least.  Words with separators at the start of a run, a key name or
a path, are left off; the first window of the largest entropy in the rest, widened to the next
separators, is the span.  It is suppressed if it, or the whole run, is on the allow-list.  Sums are scaled integers: results do
not hang on the order of floating point steps.

DataFrame functions only.  Places count code points, ends are exclusive.

Nulls, empties and repeats: a null or empty text has no spans; a null or repeated id is kept
as it is, equal rows have equal results; of windows that tie the first counts.  Very long texts
are read whole: no pattern repeats a group, so none needs stack by the length of its match, and
none starts over inside a run; spans are gathered in chunks.  Other columns may have any name but
those asked for in ``names``.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.llm.columns import gather, let, lookup
from factorloom.llm.frames import fresh

# The base patterns.  A hex or access match is kept from its least length on,
# so the length stands in the pattern; an assignment takes what it takes and is dropped after.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex")

WINDOW = 20
_SCALE = 1 << 16
_SPANS = "array<struct<start:int,rank:int,stop:int,kind:string>>"


@dataclass(frozen=True)
class CharClass:
    """Symbols of a class, and the entropy in bits from which a window counts."""

    name: str
    symbols: str
    least: float

    @property
    def pattern(self) -> str:
        own = "".join("\\" + c if c in "-+/=_" else c for c in self.symbols)
        return f"(?<![{own}])[{own}]{{{WINDOW},}}"


CLASSES = (
    CharClass("entropy_hex", "0123456789abcdefABCDEF", 3.0),
    CharClass("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
                                "0123456789+/=_-", 3.7),
)
SEPARATORS = "/=_-"
# Words before a candidate; possessive, so matched in a loop.
LEAD = "^(?:[A-Za-z]++[/=_-]++)*+"


@dataclass(frozen=True)
class Allowed:
    """What is no secret: a string that ``fits`` and has no ``flaw``."""

    fits: str
    flaw: str | None = None

    def holds(self, value: Column) -> Column:
        fits = value.rlike(self.fits)
        return fits if self.flaw is None else fits & ~value.rlike(self.flaw)


# Runs that are no secrets, universally unique ids.
ALLOWED_RUNS = (Allowed(r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}"
                        r"-[0-9a-fA-F]{12}$"),)
# Spans that are no secrets.  Words, unless capitals come and go as in random
# letters; numbers and rules; placeholders.
ALLOWED = (
    Allowed(r"^[A-Za-z+/=_-]*$", r"[a-z][A-Z][a-z]?[A-Z].*[a-z][A-Z][a-z]?[A-Z]"),
    Allowed(r"^[0-9+/=_-]*$"),
    Allowed(r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Ss][Aa][Mm][Pp][Ll][Ee]|[Dd][Uu][Mm][Mm][Yy]"
            r"|xxxx|XXXX"),
)


def _matches(text: Column, pattern: str, group: int, kind: str, rank: int, part) -> Column:
    """Spans of the matches; ``part`` of a match's group is the (first, last) that counts of
    it, or null."""
    whole = F.lit(pattern)

    def spans(found: Column) -> Column:
        values = found if group == 0 else F.regexp_extract_all(text, whole, F.lit(group))
        steps = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), found.alias("match"),
                             values.alias("value"))

        def step(state: Column, x: Column) -> Column:
            start = state["at"] + F.length(x["piece"])
            stop = start + F.coalesce(F.length(x["match"]), F.lit(0))

            def add(own: Column) -> Column:
                span = F.array(F.struct(
                    (start + own["first"]).alias("start"), F.lit(rank).alias("rank"),
                    (start + own["last"]).alias("stop"), F.lit(kind).alias("kind")))
                return F.when(own.isNotNull(), F.concat(state["out"], span)).otherwise(
                    state["out"])

            return F.struct(stop.alias("at"), let(F.when(
                x["match"].isNotNull(), part(x["match"], x["value"])), add).alias("out"))

        return gather(steps, F.array().cast(_SPANS), step)

    found = F.regexp_extract_all(text, whole, F.lit(0))
    return let(found, lambda m: F.when(F.size(m) > 0, spans(m))
               .otherwise(F.array().cast(_SPANS)))


def least_sum(candidate: Column, symbols: str, window: int = WINDOW) -> Column:
    """The least sum of c * log2(c), scaled, over the windows of a candidate string, and how
    many symbols the first such window ends after: (least, stop).

    Counts of all symbols go from step to step; each step touches the entering and the
    leaving symbol.
    """
    table = [0] + [round(c * math.log2(c) * _SCALE) for c in range(1, window + 2)]
    place = [symbols.find(chr(code)) for code in range(128)]
    codes = F.transform(F.filter(F.split(candidate, ""), lambda c: c != ""),
                        lambda c: lookup(place, F.ascii(c)))

    def slide(c: Column) -> Column:
        leaving = F.slice(F.concat(F.array_repeat(F.lit(-1).cast("long"), window), c), 1, F.size(c))
        moves = F.zip_with(c, leaving, lambda a, b: F.struct(a.alias("new"), b.alias("old")))

        def step(state: Column, move: Column) -> Column:
            counts = state["counts"]
            new, old = move["new"], move["old"]
            come = F.element_at(counts, (new + 1).cast("int"))
            gone = F.when(old >= 0, F.element_at(counts, F.greatest(old + 1, F.lit(1)).cast("int"))
                          + (old == new).cast("int")).otherwise(F.lit(0))
            total = (state["total"] + lookup(table, come + 1) - lookup(table, come)
                     - F.when(gone > 0, lookup(table, gone) - lookup(table, gone - 1))
                     .otherwise(F.lit(0).cast("long")))
            after = F.transform(counts, lambda n, k: n + (k == new).cast("int")
                                - (k == old).cast("int"))
            full = state["n"] + 1 >= window
            return F.struct(
                (state["n"] + 1).alias("n"), after.alias("counts"), total.alias("total"),
                F.when(full & (total < state["least"]["least"]), F.struct(
                    total.alias("least"), (state["n"] + 1).alias("stop")))
                .otherwise(state["least"]).alias("least"))

        zero = F.struct(F.lit(0).alias("n"),
                        F.array_repeat(F.lit(0), len(symbols)).alias("counts"),
                        F.lit(0).cast("long").alias("total"),
                        F.struct(F.lit(1 << 62).cast("long").alias("least"),
                                 F.lit(0).alias("stop")).alias("least"))
        return F.aggregate(moves, zero, step, lambda s: s["least"])

    return let(codes, slide)


def most_sum(entropy: float, window: int = WINDOW) -> int:
    """The largest scaled sum at which a window still has this entropy."""
    return math.floor(window * (math.log2(window) - entropy) * _SCALE)


def _around(run: Column, stop: Column, lead: Column) -> Column:
    """(first, last): the window that ends after ``stop`` symbols, widened to separators, in a
    string with ``lead`` more symbols before."""
    inside = "[^" + SEPARATORS.replace("-", "") + "-]"
    # the lookbehind lets a match start at the start of a part only
    before = F.regexp_extract(F.substring(run, F.lit(1), stop - WINDOW),
                              f"(?<!{inside}){inside}*+$", 0)
    after = F.regexp_extract(F.substring(run, stop + 1, F.length(run)), f"^{inside}*+", 0)
    return F.struct((lead + stop - WINDOW - F.length(before)).alias("first"),
                    (lead + stop + F.length(after)).alias("last"))


def scan(docs: DataFrame, classes: tuple[CharClass, ...] = CLASSES,
         allowed: tuple[Allowed, ...] = ALLOWED, allowed_runs: tuple[Allowed, ...] = ALLOWED_RUNS,
         names: tuple[str, str] = ("base", "spans")) -> DataFrame:
    """``docs`` with columns ``base`` and ``spans``, or as named: arrays of (start, rank,
    stop, kind) by place, the second with those of the entropy windows."""
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def all_of(least: int = 0):
        return lambda match, value: F.when(F.length(value) >= least, F.struct(
            F.lit(0).alias("first"), F.length(match).alias("last")))

    def secret(own: CharClass):
        def part(run: Column, value: Column) -> Column:
            def judged(span: Column) -> Column:
                return let(F.substring(run, span["first"] + 1, span["last"] - span["first"]),
                           lambda v: F.when(~any_of(allowed, v), span))

            def slid(rest: Column) -> Column:
                return F.when(F.length(rest) >= WINDOW, let(
                    least_sum(rest, own.symbols),
                    lambda s: F.when(s["least"] <= most_sum(own.least), let(
                        _around(rest, s["stop"], F.length(run) - F.length(rest)), judged))))

            lead = F.length(F.regexp_extract(run, LEAD, 0))
            return F.when(~any_of(allowed_runs, run), let(
                F.substring(run, lead + 1, F.length(run)), slid))
        return part

    def any_of(rules: tuple[Allowed, ...], value: Column) -> Column:
        fine = F.lit(False)
        for rule in rules:
            fine = fine | rule.holds(value)
        return fine

    base = F.array_sort(F.concat(
        _matches(t, ASSIGN, 2, "assign", 0, all_of(ASSIGN_LENGTH)),
        _matches(t, ACCESS, 0, "access", 1, all_of()), _matches(t, HEX, 0, "hex", 2, all_of())))
    more = [_matches(t, own.pattern, 0, own.name, len(KINDS) + i, secret(own))
            for i, own in enumerate(classes)]
    return docs.withColumn(names[0], base).withColumn(
        names[1], F.array_sort(F.concat(F.col(names[0]), *more)))


def described(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the contract."""
    found = scan(docs.select(F.col("doc_id").cast("long"), "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    count = [F.size(F.array_remove(kinds, k)) for k in KINDS]
    count = [(F.size(kinds) - n).cast("long").alias(f"n_{k}") for k, n in zip(KINDS, count)]
    return found.select("doc_id", *count, F.sha2(described(F.col("base")), 256)
                        .alias("base_sha256"), described(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its ``text`` replaced by ``mark``; all rows and columns.

    Spans that touch or overlap become one mark; ``n_chars``, where there is one, is the
    new length.  A null text stays null.
    """
    text = F.col("text").cast("string")
    base, spans = fresh(docs, "base"), fresh(docs, "spans")
    found = scan(docs, names=(base, spans))
    clean = _replaced(text, F.col(spans), mark)
    found = found.withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(text))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def _replaced(text: Column, spans: Column, mark: str, chunk: int = 256) -> Column:
    """``text`` with ``spans``, ordered by start, as marks.

    Spans are taken in chunks, each with the stretch of text up to its end, so that a place
    is looked up in a stretch and not in the whole text; pieces are joined once.
    """
    none = F.array().cast("array<string>")

    def whole(own: Column) -> Column:
        def part(state: Column, first: Column) -> Column:
            some = F.slice(own, first, F.lit(chunk))
            offset = state["at"]
            end = F.greatest(offset, F.array_max(F.transform(some, lambda s: s["stop"])))

            def fill(stretch: Column) -> Column:
                def step(at: Column, s: Column) -> Column:
                    apart = (s["start"] > at["at"]) | ((at["at"] == 0) & (F.size(at["out"]) == 0)
                                                       & (first == 1))
                    gap = F.substring(stretch, at["at"] - offset + 1, s["start"] - at["at"])
                    return F.struct(F.greatest(at["at"], s["stop"]).alias("at"), F.when(
                        apart, F.concat(at["out"], F.array(gap, F.lit(mark))))
                        .otherwise(at["out"]).alias("out"))

                start = F.struct(offset.alias("at"), none.alias("out"))
                return F.aggregate(some, start, step)

            return let(let(F.substring(text, offset + 1, end - offset), fill),
                       lambda s: F.struct(s["at"].alias("at"),
                                          F.concat(state["out"], s["out"]).alias("out")))

        firsts = F.sequence(F.lit(1), F.greatest(F.size(own), F.lit(1)), F.lit(chunk))
        return F.aggregate(
            firsts, F.struct(F.lit(0).alias("at"), none.alias("out")), part,
            lambda s: F.concat(F.array_join(s["out"], ""),
                               F.substring(text, s["at"] + 1, F.length(text))))

    return let(spans, whole)
