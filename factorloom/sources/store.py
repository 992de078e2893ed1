"""Stored tables in the session's catalog, written by Spark's own writers.

A table that is replaced as a whole is a view over its newest *generation*, a table of its
own: the new generation is written and checked first, then the view is pointed to it, so that
readers see the old or the new one and a plan may read what it replaces.  The generation before
stays for readers under way.  A table that grows is one Parquet table: appends go by ``insertInto``,
new columns by ``ALTER TABLE``, merges overwrite the partitions they touch and no others
(``partitionOverwriteMode=dynamic``), in one commit of Spark's writer.

With a metastore the catalog outlives the session; without one it lasts as long as the session.
One writer per table at a time, as in a scheduled run.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factorloom.catalogue import TableSpec
from factorloom.operators.checks import Check, audit, observed
from factorloom.operators.incremental import merge_latest
from factorloom.session import cut_lineage, small_side

# Target file size, retention of the audit log.
TARGET_MB = 128
KEEP_DAYS = 60
# Names the generations of a table, and the partition column that names a load.
GENERATION = "__g"
LOAD = "load_batch"
# Distinct values a lookup column's bloom filter is laid out for, per row group.
LOOKUP_VALUES = 100_000


class Warehouse:
    """The tables of one database, in a folder that all executors can reach."""

    def __init__(self, spark: SparkSession, location: str, database: str | None = None):
        self.spark = spark
        self.location = location.rstrip("/")
        self.database = database or "loom_" + hashlib.sha256(
            self.location.encode()).hexdigest()[:16]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.location}'")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def of(self, spark: SparkSession) -> Warehouse:
        """The same tables through another session, whose settings its writes follow."""
        return Warehouse(spark, self.location, self.database)

    # Reading -------------------------------------------------------------------------------

    def refresh(self, name: str) -> None:
        """See what other sessions have written since."""
        self.spark.catalog.refreshTable(f"{self.database}.{name}")

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.name(name))

    def read_or_none(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def generations(self, name: str) -> list[str]:
        """The tables of a replaced table's generations, oldest first."""
        rows = self.spark.sql(
            f"SHOW TABLES IN `{self.database}` LIKE '{name}{GENERATION}*'").collect()
        return sorted(r["tableName"] for r in rows)

    def _table(self, name: str) -> str:
        """The table behind a name: the newest generation of a replaced one."""
        found = self.generations(name)
        return found[-1] if found else name

    def file_count(self, name: str) -> int:
        return len(self.read(name).inputFiles())

    # Replacing -----------------------------------------------------------------------------

    def replace(self, df: DataFrame, spec: TableSpec, checks: Sequence[Check] = (),
                parents: dict[str, DataFrame] | None = None, as_of=None,
                options: dict[str, str] | None = None) -> DataFrame | None:
        """Write a new generation and publish it, if its checks pass.

        What a row tells is counted by the writing job itself; keys are counted on what it has
        written.  A failing check raises ``FailedChecks``, drops the new generation and
        leaves the published one.  Returns the checks' results.
        """
        held = self.generations(spec.name)
        number = int(held[-1].rsplit(GENERATION, 1)[1][:6]) + 1 if held else 1
        # a name of its own: a write that never ended leaves a folder nobody asks for
        new = f"{spec.name}{GENERATION}{number:06d}_{uuid.uuid4().hex[:8]}"
        results = None
        if checks:
            df, counts = observed(df, checks, as_of)
        self._write(df, spec, new, options)
        if checks:
            try:
                results = audit(self.read(new), checks, spec.name, counts.get, parents, as_of)
            except BaseException:
                self.spark.sql(f"DROP TABLE {self.name(new)}")
                raise
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(spec.name)} AS "
                       f"SELECT * FROM {self.name(new)}")
        for old in held[:-1]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(old)}")
        return results

    def swap(self, df: DataFrame, name: str, sort_by: tuple[str, ...] = (),
             checks: Sequence[Check] = ()) -> None:
        """Replace a serving table, range-sorted by its lookup columns.

        Statistics of row groups and pages on the sort columns, and bloom filters on those of
        text, take the place of indexes.
        """
        options = {}
        if sort_by:
            df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
            for c in sort_by:
                if df.schema[c].dataType.typeName() == "string":
                    options[f"parquet.bloom.filter.enabled#{c}"] = "true"
                    options[f"parquet.bloom.filter.expected.ndv#{c}"] = str(LOOKUP_VALUES)
        self.replace(df, TableSpec(name, "", (), ()), checks, options=options)

    def _write(self, df: DataFrame, spec: TableSpec, table: str,
               options: dict[str, str] | None = None) -> None:
        writer = _sorted(df, spec).write.format("parquet").options(**(options or {}))
        if spec.partition_by:
            writer = writer.partitionBy(*spec.partition_by)
        writer.saveAsTable(self.name(table))

    # Growing -------------------------------------------------------------------------------

    def create(self, spec: TableSpec, schema: StructType | None = None) -> None:
        """An empty table of its declared columns, or of those given."""
        if not self.exists(spec.name):
            kind = spec.schema if spec.columns else schema
            self._write(self.spark.createDataFrame([], _nullable(kind)),
                        TableSpec(spec.name, "", spec.partition_by, ()), spec.name)

    def widen(self, name: str, schema: StructType) -> None:
        """Add the columns of ``schema`` that a table lacks; old rows read NULL in them."""
        held = {c.lower() for c in self.read(name).columns}
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
               if f.name.lower() not in held]
        if new:
            self.spark.sql(f"ALTER TABLE {self.name(name)} ADD COLUMNS ({', '.join(new)})")

    def append(self, df: DataFrame, spec: TableSpec, batch: str | None = None) -> None:
        """Append by column name; new columns widen the table, missing ones read as NULL.

        A table that does not exist yet starts from its declared columns.  A load that is
        appended again under its ``batch`` replaces its first try: loads of a table that names
        them are partitions of their own.
        """
        if batch is not None:
            df = df.withColumn(LOAD, F.lit(batch))
            spec = TableSpec(spec.name, spec.columns and f"{spec.columns}, {LOAD} string",
                             (*spec.partition_by, LOAD), spec.sort_desc)
        self.create(spec, df.schema)
        self.widen(spec.name, df.schema)
        rows = _sorted(self._aligned(df, spec.name), spec)
        if batch is None:
            rows.write.insertInto(self.name(spec.name))
        else:
            self.drop_partitions(spec.name, [Row(**{LOAD: batch})])
            with self._dynamic():
                rows.write.insertInto(self.name(spec.name), overwrite=True)

    def merge(self, source: DataFrame, spec: TableSpec, keys: Sequence[str],
              checks: Sequence[Check] = (), parents: dict[str, DataFrame] | None = None,
              as_of=None) -> None:
        """Upsert rows, one per key, into a table, if they pass their checks.

        Touched are the partitions in which the source has rows, NULL ones too, and, where the
        partition is no part of the key, those in which its keys are held.  They are merged,
        stored and overwritten in one commit; one that is left without rows is dropped.  The
        partitions are listed on the driver, as the catalog lists them.
        """
        if checks:
            source, counts = observed(source, checks, as_of)
        staged = cut_lineage(source, "merge-source")
        if checks:
            audit(staged, checks, spec.name, counts.get, parents, as_of)
        self.create(spec, staged.schema)
        self.widen(spec.name, staged.schema)
        held, by = self.read(spec.name), list(spec.partition_by)
        new = self._aligned(staged, spec.name)
        if not by:
            merged = cut_lineage(merge_latest(held, new, keys), "merged")
            _sorted(merged, spec).write.insertInto(self.name(spec.name), overwrite=True)
            return
        touched = new.select(*by).distinct()
        if not set(by) <= set(keys):
            same = [F.col(f"h.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
            at = held.select(*keys, *[F.col(c).alias(f"_at_{c}") for c in by]).alias("h").join(
                new.select(*keys).alias("n"), same, "left_semi")
            touched = touched.union(at.select(*[f"_at_{c}" for c in by])).distinct()
        places = touched.collect()
        merged = cut_lineage(merge_latest(held.where(_at(places, by)), new, keys), "merged")
        filled = set(merged.select(*by).distinct().collect())
        with self._dynamic():
            _sorted(merged, spec).write.insertInto(self.name(spec.name), overwrite=True)
        self.drop_partitions(spec.name, [p for p in places if p not in filled])

    def _aligned(self, df: DataFrame, name: str) -> DataFrame:
        """The table's columns by name, in its order and types."""
        have = {c.lower() for c in df.columns}
        return df.select(*[
            (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType)
            .alias(f.name) for f in self.read(name).schema.fields])

    @contextmanager
    def _dynamic(self):
        """Overwriting replaces the partitions that are written only."""
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "dynamic")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def drop_partitions(self, name: str, places: Sequence[Row]) -> None:
        """Drop partitions, given by some or all of their columns."""
        if not places:
            return
        by = [c.name for c in self.spark.catalog.listColumns(f"{self.database}.{name}")
              if c.isPartition]
        given = list(places[0].asDict())
        if set(given) != set(by):
            places = self.read(name).where(_at(places, given)).select(*by).distinct().collect()
        for place in places:
            spec = ", ".join(f"`{c}` = {_literal(v)}" for c, v in place.asDict().items())
            self.spark.sql(f"ALTER TABLE {self.name(name)} DROP IF EXISTS PARTITION ({spec})")

    # Upkeep --------------------------------------------------------------------------------

    def expire(self, name: str, column: str, as_of: date, keep_days: int = KEEP_DAYS) -> None:
        """Drop the day partitions before the retained days; no row is read."""
        days = self.read(name).select(column).distinct()
        old = F.col(column) < F.date_sub(F.lit(as_of), keep_days)
        self.drop_partitions(name, days.where(old).collect())

    def compact(self, spec: TableSpec, target_mb: int = TARGET_MB) -> None:
        """Rewrite the partitions that have more files than their bytes need.

        Sizes come from the files' own metadata column; other partitions keep their files.
        """
        table, by = self._table(spec.name), list(spec.partition_by)
        rows = self.spark.table(self.name(table))
        files = rows.select(*by, F.col("_metadata.file_path").alias("_path"),
                            F.col("_metadata.file_size").alias("_size")).distinct()
        need = F.greatest(F.ceil(F.sum("_size") / (target_mb << 20)), F.lit(1)).cast("int")
        sizes = small_side(files.groupBy(*by).agg(
            F.count(F.lit(1)).alias("_now"), need.alias("_need")).where("_now > _need"))
        if by:
            match = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
            crowded = rows.alias("l").join(sizes.alias("r"), match).select("l.*", "r._need")
            slot = F.pmod(F.monotonically_increasing_id(), F.col("_need"))
            full = cut_lineage(crowded.withColumn("_slot", slot).drop("_need"), "crowded")
            full = full.repartition(*by, "_slot").drop("_slot")
            with self._dynamic():
                _sorted(full, spec).write.insertInto(self.name(table), overwrite=True)
            return
        for (_, wanted) in sizes.collect():
            full = cut_lineage(rows, "crowded").repartition(wanted)
            _sorted(full, spec).write.insertInto(self.name(table), overwrite=True)


def _sorted(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Partition columns last, rows in the declared order inside each task."""
    rest = [c for c in df.columns if c not in spec.partition_by]
    df = df.select(*[F.col(f"`{c}`") for c in (*rest, *spec.partition_by)])
    order = [F.desc_nulls_last(c) for c in spec.sort_desc if c in df.columns]
    # the writer wants partition columns first; the declared order follows them
    return df.sortWithinPartitions(*spec.partition_by, *order) if order else df


def _nullable(schema: StructType) -> StructType:
    out = StructType()
    for f in schema.fields:
        out.add(f.name, f.dataType, True)
    return out


def _at(places: Sequence[Row], by: Sequence[str]) -> Column:
    """Whether a row is in one of the partitions; prunes the scan."""
    if len(by) == 1:
        values = [p[0] for p in places]
        inside = F.col(by[0]).isin([v for v in values if v is not None])
        return inside | F.col(by[0]).isNull() if None in values else inside
    each = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, p)])
            for p in places]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int, float)):
        return str(value)
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def export_csv(df: DataFrame, path: str, order: list | None = None,
               single_file: bool = False) -> None:
    """CSV with a header, in ordered shards; ``single_file`` asks for one file, written by
    one task."""
    rows = df.orderBy(*order) if order else df
    if single_file:
        rows = rows.coalesce(1)
    rows.write.mode("errorifexists").csv(path, header=True)


def export_seed(df: DataFrame, path: str, audit: tuple[str, ...] = (
        "bronze_ingested_time", "staged_at", "staging_invocation_id", "silver_updated_at",
        "silver_invocation_id")) -> None:
    """CSV copy of a dimension without its audit columns, sharded by Spark."""
    df.drop(*audit).write.mode("errorifexists").csv(path, header=True)
