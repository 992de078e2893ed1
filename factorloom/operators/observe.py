"""Monitoring tables: metric anomalies, run results, alerts, schema changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.operators.aggregates import min_max_group
from factorloom.operators.combine import union_runs
from factorloom.operators.ranking import row_numbers
from factorloom.operators.windows import running_stats
from factorloom.session import small_side

METRIC_KEY = ("metric_name", "full_table_name", "column_name")

# Score limit of an anomaly, steps of the sensitivity table, days looked back.
ANOMALY_LIMIT = 3
SENSITIVITY = (1.5, 2, 2.5, 3, 3.5, 4, 4.5)
DETECTION_DAYS = 7


def metrics_anomaly_score(metrics: DataFrame, as_of: datetime,
                          days: int = DETECTION_DAYS) -> DataFrame:
    """Each recent metric value against the mean and deviation of its history so far.

    A series has one row per bucket, so its window is bounded by the buckets monitored.
    """
    stats = running_stats(metrics.distinct(), METRIC_KEY, "bucket_start", "metric_value",
                          "bucket_end")
    spread = F.col("training_stddev")
    score = (
        F.when(spread.isNull() | (F.col("training_set_size") == 1), F.lit(None).cast("double"))
        .when(spread == 0, F.lit(0.0))
        .otherwise((F.col("metric_value") - F.col("training_avg")) / F.nullif(spread, F.lit(0.0)))
    )
    cutoff = datetime(as_of.year, as_of.month, as_of.day, tzinfo=as_of.tzinfo)
    recent = stats.withColumn("anomaly_score", score).where(
        F.col("metric_value").isNotNull() & F.col("training_avg").isNotNull()
        & (F.col("bucket_end") >= F.lit(cutoff - timedelta(days=days)))
    )
    keys = [c for c in recent.columns if c not in ("updated_at", "source_value",
                                                  "bucket_duration_hours")]
    latest = recent.groupBy(*keys).agg(F.max("updated_at").alias("updated_at"))
    flag = F.coalesce(F.abs("anomaly_score") > ANOMALY_LIMIT, F.lit(False))
    return latest.withColumnRenamed("metric_value", "latest_metric_value").withColumn(
        "is_anomaly", flag)


def anomaly_sensitivity(scores: DataFrame, steps: Sequence[float] = SENSITIVITY) -> DataFrame:
    """Which scores would count as anomalies at other limits."""
    size = F.abs("anomaly_score")
    flags = [
        (size >= s).alias("is_anomaly_" + f"{s:g}".replace(".", "_")) for s in steps
    ]
    return scores.where(size >= min(steps)).select(
        "full_table_name", "column_name", "metric_name", "latest_metric_value",
        F.col("training_avg").alias("metric_avg"),
        F.col("training_stddev").alias("metric_stddev"), "anomaly_score", *flags,
    )


def monitor_runs(metrics: DataFrame, keys: Sequence[str] = METRIC_KEY) -> DataFrame:
    return min_max_group(metrics, keys, "bucket_end", "first_bucket_end", "last_bucket_end")


def with_day_ends(runs: DataFrame, by: str = "generated_at",
                  ident: str = "invocation_id") -> DataFrame:
    """Mark runs of the first and the last invocation of their day.

    The two ends of a day come from a combining aggregate; a window over all runs of a day
    would put the day into one task.
    """
    day = F.date_trunc("day", F.col(by))
    ends = runs.groupBy(day.alias("_day")).agg(
        F.min(F.struct(by, ident))[ident].alias("_first"),
        F.max(F.struct(by, ident))[ident].alias("_last"),
    )
    joined = runs.withColumn("_day", day).join(small_side(ends), "_day")
    return joined.withColumns({
        "is_the_first_invocation_of_the_day": F.col("_first") == F.col(ident),
        "is_the_last_invocation_of_the_day": F.col("_last") == F.col(ident),
    }).drop("_day", "_first", "_last")


def with_reverse_index(runs: DataFrame, key: str = "unique_id", by: str = "generated_at",
                       tie: str = "model_execution_id",
                       out: str = "model_invocation_reverse_index") -> DataFrame:
    """Newest-first position of each run of a model, for models with any number of runs."""
    return row_numbers(runs, [key], [F.col(by).desc(), F.col(tie).asc()], out)


def _describe(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Runs with the attributes of their node; the run's own materialization wins."""
    own = nodes.withColumnRenamed("materialization", "_node_materialization")
    joined = runs.join(small_side(own), "unique_id")
    best = F.coalesce("materialization", "_node_materialization")
    return joined.withColumn("materialization", best).drop("_node_materialization")


def model_run_results(runs: DataFrame, models: DataFrame) -> DataFrame:
    return with_day_ends(with_reverse_index(_describe(runs, models)))


def snapshot_seed_run_results(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    return _describe(runs, nodes)


def job_run_results(invocations: DataFrame) -> DataFrame:
    """Start, end and length in seconds of each job run."""
    jobs = invocations.where(F.col("job_id").isNotNull()).groupBy(
        "job_name", "job_id", "job_run_id"
    ).agg(F.min("run_started_at").alias("run_started_at"),
          F.max("run_completed_at").alias("run_completed_at"))
    seconds = F.timestamp_diff("SECOND", F.col("run_started_at"), F.col("run_completed_at"))
    return jobs.select(
        F.col("job_name").alias("name"), F.col("job_id").alias("id"),
        F.col("job_run_id").alias("run_id"), "run_started_at", "run_completed_at",
        seconds.alias("run_execution_time"),
    )


def alerts(results: DataFrame, kind: str, type_col: str = "test_type") -> DataFrame:
    """Results of one type that neither passed nor were skipped."""
    open_ = ~F.lower("status").isin("pass", "skipped")
    return results.where(open_ & (F.col(type_col) == kind))


def alerts_union(test_results: DataFrame, model_runs: DataFrame, freshness: DataFrame) -> DataFrame:
    """Alert rows of all kinds in one table: id, kind, status, detected_at.

    Test results bring dbt_test, anomaly_detection and schema_change rows; runs and freshness
    results come from their own tables.
    """
    tests = union_runs(*[
        alerts(test_results, kind)
        for kind in ("dbt_test", "anomaly_detection", "schema_change")
    ]).select(F.col("id").alias("alert_id"), F.col("test_type").alias("alert_type"), "status",
              "detected_at")
    runs = model_runs.where(~F.lower("status").isin("success", "skipped")).select(
        F.col("model_execution_id").alias("alert_id"), F.lit("model").alias("alert_type"),
        "status", F.col("generated_at").alias("detected_at"))
    sources = freshness.where(F.lower("status") != "pass").select(
        F.col("source_freshness_execution_id").alias("alert_id"),
        F.lit("source_freshness").alias("alert_type"), "status",
        F.col("generated_at").alias("detected_at"))
    return union_runs(tests, runs, sources)


def schema_snapshot(df: DataFrame, table: str, previous: DataFrame | None,
                    detected_at: datetime) -> DataFrame:
    """One row per column of a table, flagged when the previous snapshot lacks it."""
    rows = [(f"{table}.{f.name}", table, f.name, f.dataType.simpleString()) for f in df.schema]
    now = df.sparkSession.createDataFrame(
        rows, "full_column_name string, full_table_name string, column_name string,"
              " data_type string")
    if previous is None:
        flagged = now.withColumn("is_new", F.lit(False))
    else:
        known = previous.select("full_column_name").distinct().withColumn("_known", F.lit(True))
        flagged = now.join(known, "full_column_name", "left").withColumn(
            "is_new", F.col("_known").isNull()).drop("_known")
    return flagged.withColumn("detected_at", F.lit(detected_at))
