"""Chat formatting: logged snapshots of growing conversations are collapsed, then rendered.

Every turn gets a position and the hash of all turns up to it.  A conversation whose hash at its
length is the hash of a longer conversation at that length is a snapshot of it; an anti-join
leaves the maximal conversations, of equal ones that with the least id.  Hashes roll over
blocks of 1,024 turns, and blocks roll over their own hashes, so a conversation that has a
third of all turns is never gathered in one task.  Rendered text comes in parts of a bounded
number of turns, in order.

DataFrame functions only.

Nulls, empties and repeats: rows with a null conversation id form one conversation with that id;
a null turn comes first; turns that share a number come in order of role and text; equal rows
are one turn, logged twice; a null role or text renders as empty but is no snapshot of an
empty one.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factorloom.llm.frames import stored

BLOCK = 1024
PART_TURNS = 1000
SEEDS = (31, 37)


def positions(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) without repeats, with ``pos`` from 0."""
    turns = turns.select("conv_id", F.col("turn").cast("long"), F.col("role").cast("string"),
                         F.col("text").cast("string")).distinct()
    turns = turns.withColumn("slice", F.coalesce(F.floor(F.col("turn") / BLOCK),
                                                 F.lit(-(1 << 62))))
    order = Window.partitionBy("conv_id", "slice").orderBy("turn", "role", "text")
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = turns.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("conv_id").alias("c"), F.col("slice").alias("s"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = turns.withColumn("at", F.row_number().over(order))
    joined = ranked.join(offsets, ranked["conv_id"].eqNullSafe(offsets["c"])
                         & (ranked["slice"] == offsets["s"]))
    return joined.select("conv_id", "role", "text", (F.col("offset") + F.col("at") - 1)
                         .alias("pos"))


def _chain(hashes: Column, start: Column) -> Column:
    """The hashes of all prefixes of an array of (h1, h2), each rolled on from the last."""
    def step(state: Column, x: Column) -> Column:
        now = F.struct(*[F.xxhash64(state["now"][h], x[h]).alias(h) for h in ("h1", "h2")])
        return F.struct(now.alias("now"), F.concat(state["out"], F.array(now)).alias("out"))

    empty = F.array().cast("array<struct<h1:bigint,h2:bigint>>")
    return F.aggregate(hashes, F.struct(start.alias("now"), empty.alias("out")), step,
                       lambda s: s["out"])


def _pair(a: int, b: int) -> Column:
    return F.struct(F.lit(a).cast("long").alias("h1"), F.lit(b).cast("long").alias("h2"))


def prefixes(placed: DataFrame) -> DataFrame:
    """(conv_id, length, h1, h2, n): the hash of each conversation's first ``length`` turns."""
    marks = [F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    turn = F.struct("pos", *[F.xxhash64(F.lit(s), *marks).alias(h)
                             for s, h in zip(SEEDS, ("h1", "h2"))])
    blocks = (placed.select("conv_id", F.floor(F.col("pos") / BLOCK).alias("block"),
                            turn.alias("x"))
              .groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("x")).alias("xs")))
    hashes = F.transform("xs", lambda x: F.struct(x["h1"], x["h2"]))
    blocks = stored(blocks.select("conv_id", "block", hashes.alias("xs")), "turn-blocks")
    # whole blocks first: their digests roll on, and give each block the hash it starts from
    whole = blocks.select("conv_id", "block", F.size("xs").alias("n"),
                          F.element_at(_chain(F.col("xs"), _pair(3, 5)), -1).alias("digest"))
    rolled = whole.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("block", "n", "digest"))).alias("bs")).select(
        F.col("conv_id").alias("c"),
        F.aggregate("bs", F.lit(0).cast("long"), lambda s, b: s + b["n"]).alias("n"),
        F.concat(F.array(_pair(7, 11)), _chain(
            F.transform("bs", lambda b: b["digest"]), _pair(7, 11))).alias("starts"))
    starts = rolled.select("c", "n", F.posexplode("starts").alias("b", "start"))
    joined = blocks.join(starts, blocks["conv_id"].eqNullSafe(starts["c"])
                         & (blocks["block"] == starts["b"]))
    return joined.select("conv_id", "n", F.col("block"), F.posexplode(
        _chain(F.col("xs"), F.col("start"))).alias("i", "h")).select(
        "conv_id", (F.col("block") * BLOCK + F.col("i") + 1).alias("length"), "h.h1", "h.h2", "n")


def maximal(rolled: DataFrame) -> DataFrame:
    """(conv_id, copies): conversations that no longer one starts with; least id of equals."""
    whole = rolled.where("length = n").groupBy("length", "h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    inner = rolled.where("length < n").select("length", "h1", "h2").distinct()
    return whole.join(inner, ["length", "h1", "h2"], "left_anti").select("conv_id", "copies")


def render(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Maximal conversations as text: conv_id, part, n_turns, copies, rendered.

    ``copies`` counts the equal conversations, ``n_turns`` the turns of the part.  A turn is
    framed by start and end marks; marks inside a text are broken by a blank.
    """
    placed = stored(positions(turns), "turns")
    kept = maximal(stored(prefixes(placed), "prefixes")).withColumnRenamed("conv_id", "kept_id")
    own = placed.join(kept, placed["conv_id"].eqNullSafe(kept["kept_id"]))
    plain = [F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
             for c in (F.col("role"), F.col("text"))]
    line = F.concat(F.lit("<|im_start|>"), plain[0], F.lit("\n"), plain[1],
                    F.lit("<|im_end|>\n"))
    return (own.select("conv_id", "copies", "pos", line.alias("line"),
                       F.floor(F.col("pos") / part_turns).alias("part"))
            .groupBy("conv_id", "copies", "part")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
            .select("conv_id", F.col("part").cast("long"),
                    F.size("lines").cast("long").alias("n_turns"), "copies",
                    F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("rendered")))
