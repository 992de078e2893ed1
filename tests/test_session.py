"""Lineage cuts and stored sides."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from factorloom.session import SHUFFLES_GO, cut_lineage, small_side


def _held(spark):
    """Shuffles whose files the executors still keep."""
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


@pytest.mark.parametrize("store", [cut_lineage, small_side])
def test_a_stored_step_leaves_no_shuffle_files(spark, store):
    spark._jvm.System.gc()
    frame = spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count()
    before, setting = _held(spark), spark.conf.get(SHUFFLES_GO, None)
    stored = store(frame)
    assert _held(spark) <= before
    assert spark.conf.get(SHUFFLES_GO, None) == setting
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, frame.collect()))


def test_the_setting_comes_back_after_a_failure(spark):
    setting = spark.conf.get(SHUFFLES_GO, None)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no"):
        cut_lineage(broken)
    assert spark.conf.get(SHUFFLES_GO, None) == setting
