"""Helpers of the operators: stored steps, row numbers, task ids, connected components."""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def task_id() -> int:
    """The number of the running task's partition; the same when the task is run again."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def sized(df: DataFrame, column: str) -> int:
    """The summed bytes of a string column."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column, *more: Column) -> list[Column]:
    """128 bits that identify a row's text (and what else is given), as two longs."""
    return [F.xxhash64(F.lit(11), text, *more).alias("k1"),
            F.xxhash64(F.lit(23), *more, text, F.length(text)).alias("k2")]


def joined_sorted(values: Column) -> Column:
    """Distinct values, as strings in order, comma-joined and hashed."""
    return F.sha2(F.array_join(F.array_sort(F.transform(values, lambda v: v.cast("string"))),
                               ","), 256)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b): the smallest id it is connected with.

    Alternates two steps, each an aggregate and a join: every id hands its larger neighbours,
    then its smaller ones, to its smallest neighbour.  Stars form after about log n rounds.  A hub's
    neighbours are never collected: the smallest one is an aggregate that combines on the map
    side, and the join on a busy hub is split by Spark.  Ends when a round changes nothing.
    """
    links = stored(
        edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .where("low < high").distinct(), "links")
    state = None
    for _ in range(rounds):
        both = links.union(links.select("high", "low")).toDF("id", "near")
        least = both.groupBy("id").agg(F.min("near").alias("least")).select(
            "id", F.least("id", "least").alias("least"))
        large = (both.where("near > id").join(least, "id")
                 .select(F.col("least").alias("low"), F.col("near").alias("high"))
                 .where("low < high").distinct())
        small = large.groupBy("high").agg(F.min("low").alias("least"))
        pairs = large.join(small, "high")
        links = stored(
            pairs.select(F.col("least").alias("low"), "high")
            .union(pairs.select(F.col("least"), F.col("low")))
            .where("low < high").distinct(), "links")
        now = links.agg(F.count(F.lit(1)),
                        F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("high").alias("id"), F.col("low").alias("component")).union(
        links.select("low", "low").distinct())
