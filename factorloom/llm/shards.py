"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows of each input partition go to each shard has, under a uniform permutation, a
multivariate hypergeometric law.  The matrix is drawn first: partitions are halved again and
again, and each half's share of every shard is one exact hypergeometric draw, by inversion of the
probabilities around the mode.  Then rows are permuted inside their partition, dealt to the
shards by the matrix, and permuted again inside the shard, in runs of bounded size that
the random key divides.  Rows are numbered once and stored, so a task that runs again deals
the same rows alike.

DataFrame functions only.

Nulls, empties and repeats: a null text counts as empty; a null or repeated id is a row like
any other, equal rows are dealt apart; columns named like the added ones are kept where the
names are free.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factorloom.llm.columns import let
from factorloom.llm.frames import stored

SHARDS = 40
RUN_ROWS = 1 << 20


def uniform(*parts) -> Column:
    """A number in (0, 1) that hangs on the parts only."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11) + F.lit(0.5)) / F.lit(2.0 ** 53)


def hypergeometric(good: Column, total: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` from ``total`` items, ``good`` of them marked, are marked.

    The weights of the outcomes follow from the mode's by their ratios, up to 14 deviations and
    30 outcomes away, beyond which they vanish in double precision; ``u`` picks one.
    """
    k, n, m = (c.cast("double") for c in (good, total, draws))
    low, high = F.greatest(F.lit(0.0), m - (n - k)), F.least(m, k)
    mode = F.greatest(low, F.least(high, F.floor((m + 1) * (k + 1) / (n + 2)).cast("double")))
    spread = F.sqrt(m * k * (n - k) * (n - m) / (n * n * F.greatest(n - 1, F.lit(1.0))))
    reach = F.ceil(14 * spread) + 30
    frame = F.struct(
        k.alias("k"), n.alias("n"), m.alias("m"), mode.alias("mode"), u.alias("u"),
        F.least(high, mode + reach).alias("high"), F.greatest(low, mode - reach).alias("low"))

    def steps(count: Column) -> Column:
        return F.when(count >= 1, F.sequence(F.lit(1), F.greatest(count, F.lit(1)).cast("int"))
                      ).otherwise(F.array().cast("array<int>"))

    def drawn(f: Column) -> Column:
        def up(x: Column) -> Column:  # from x - 1 to x
            return (f["k"] - x + 1) * (f["m"] - x + 1) / (
                x * (f["n"] - f["k"] - f["m"] + x))

        def down(x: Column) -> Column:  # from x + 1 to x
            return (x + 1) * (f["n"] - f["k"] - f["m"] + x + 1) / (
                (f["k"] - x) * (f["m"] - x))

        def walk(count, ratio, sign, target, first):
            """Weights summed outcome by outcome, and the first outcome to pass ``target``."""
            def step(state: Column, i: Column) -> Column:
                x = f["mode"] + sign * i
                w = state["w"] * ratio(x)
                s = state["sum"] + w
                return F.struct(w.alias("w"), s.alias("sum"), F.when(
                    state["pick"].isNull() & (s >= target), x).otherwise(state["pick"])
                    .alias("pick"))

            return F.aggregate(steps(count), F.struct(
                F.lit(1.0).alias("w"), first.alias("sum"),
                F.lit(None).cast("double").alias("pick")), step)

        never, up_count, down_count = F.lit(1e308), f["high"] - f["mode"], f["mode"] - f["low"]
        rising = walk(up_count, up, 1, never, F.lit(1.0))["sum"]
        falling = walk(down_count, down, -1, never, F.lit(0.0))["sum"]
        return let(F.struct(rising.alias("up"), (f["u"] * (rising + falling)).alias("target")),
                   lambda t: F.when(t["target"] <= 1, f["mode"])
                   .when(t["target"] <= t["up"], F.coalesce(
                       walk(up_count, up, 1, t["target"], F.lit(1.0))["pick"], f["mode"]))
                   .otherwise(F.coalesce(
                       walk(down_count, down, -1, t["target"], t["up"])["pick"], f["mode"]))
                   .cast("long"))

    return let(frame, drawn)


def communication(counts: DataFrame, partitions: int, rows: int, shards: int,
                  seed: int) -> DataFrame:
    """(part, cuts): for each partition, up to where its permuted rows go to each shard.

    ``counts`` has (part, n).  Level by level every node of a binary tree over the partitions
    splits its shard sizes between its halves; nodes of a level are independent.
    """
    sizes = F.array(*[F.lit(rows // shards + (s < rows % shards)).cast("long")
                      for s in range(shards)])
    nodes = counts.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("parts")).select(
        F.lit(1).cast("long").alias("node"), "parts", sizes.alias("sizes"))

    def total(parts: Column) -> Column:
        return F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s + p["n"])

    def share(sizes: Column, left: Column, node: Column) -> Column:
        def step(state: Column, size: Column) -> Column:
            got = F.when((state["need"] <= 0) | (size <= 0), F.lit(0).cast("long")).when(
                state["need"] >= state["rest"], size).otherwise(hypergeometric(
                    size, state["rest"], state["need"],
                    uniform(F.lit(seed), node, F.size(state["out"]))))
            return let(got, lambda g: F.struct(
                (state["rest"] - size).alias("rest"), (state["need"] - g).alias("need"),
                F.concat(state["out"], F.array(g)).alias("out")))

        start = F.struct(F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b)
                         .alias("rest"), left.alias("need"),
                         F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(sizes, start, step, lambda s: s["out"])

    for _ in range(max(0, partitions - 1).bit_length()):
        half = F.ceil(F.size("parts") / 2).cast("int")
        low = F.slice("parts", F.lit(1), half)
        high = F.slice("parts", half + 1, F.size("parts") - half)
        cut = nodes.select("node", "parts", "sizes", low.alias("low"), high.alias("high")).select(
            "*", F.when(F.size("high") > 0, share(F.col("sizes"), total(F.col("low")),
                                                 F.col("node"))).alias("left"))
        both = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("low").alias("parts"),
                     F.col("left").alias("sizes")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.col("high").alias("parts"),
                     F.zip_with("sizes", "left", lambda a, b: a - b).alias("sizes")))
        alone = F.array(F.struct("node", "parts", "sizes"))
        nodes = cut.select(F.explode(F.when(F.size("high") > 0, both).otherwise(alone))
                           .alias("x")).select("x.*")
        nodes = nodes.repartition("node")
    running = F.aggregate("sizes", F.array().cast("array<bigint>"), lambda out, n: F.concat(
        out, F.array(F.coalesce(F.element_at(out, F.when(F.size(out) > 0, -1).otherwise(None)),
                                F.lit(0).cast("long")) + n)))
    return nodes.where(F.size("parts") > 0).select(
        F.get("parts", F.lit(0))["part"].alias("part"), running.alias("cuts"))


def shuffle_rows(df: DataFrame, shards: int = SHARDS, seed: int = 29,
                 run_rows: int = RUN_ROWS) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: a uniform shuffle, shard sizes at most one apart."""
    columns = df.columns
    inner = {c: f"c{i}" for i, c in enumerate(columns)}
    dealt = stored(df.toDF(*inner.values()).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")),
        "rows")
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    partitions, rows = counts.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    matrix = stored(communication(counts, partitions, rows, shards, seed), "matrix")

    first = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed + 1), "row"), "row")
    placed = dealt.withColumn("place", F.row_number().over(first) - 1).join(matrix, "part")
    sent = stored(placed.select(
        *inner.values(), "row",
        F.size(F.filter("cuts", lambda c: c <= F.col("place"))).alias("shard"),
        F.xxhash64(F.lit(seed + 2), "row").alias("key")), "dealt")
    bits = max(0, -(-rows // (shards * run_rows)) - 1).bit_length()
    run = F.shiftright("key", 63 - bits).alias("run")
    sent = sent.withColumn("run", run)
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sent.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    second = Window.partitionBy("shard", "run").orderBy("key", "row")
    out = sent.withColumn("at", F.row_number().over(second)).join(offsets, ["shard", "run"])
    return out.select(*[F.col(i).alias(c) for c, i in inner.items()], "shard",
                      (F.col("offset") + F.col("at") - 1).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 29) -> DataFrame:
    """The contract's rows: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"),
                       (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return shuffle_rows(rows, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
