"""Column helpers for operators made of DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lookup(numbers: list[int], at: Column) -> Column:
    """The entry of a fixed table, counted from 0."""
    return F.element_at(F.array(*[F.lit(n).cast("long") for n in numbers]), at.cast("int") + 1)


def gather(items: Column, empty: Column, step: Callable[[Column, Column], Column],
           chunk: int = 256) -> Column:
    """The array that ``step`` gathers over ``items``, from state (at, out) to the next.

    Appending copies the array gathered so far, so items are taken in chunks: each fills an
    array of its own, and only the chunks are appended to the whole.
    """
    def whole(own: Column) -> Column:
        def part(state: Column, first: Column) -> Column:
            start = F.struct(state["at"].alias("at"), empty.alias("out"))
            return let(F.aggregate(F.slice(own, first, F.lit(chunk)), start, step),
                       lambda s: F.struct(s["at"].alias("at"),
                                          F.concat(state["out"], s["out"]).alias("out")))

        firsts = F.sequence(F.lit(1), F.greatest(F.size(own), F.lit(1)), F.lit(chunk))
        return F.aggregate(firsts, F.struct(F.lit(0).alias("at"), empty.alias("out")), part,
                           lambda s: s["out"])

    return let(items, whole)
