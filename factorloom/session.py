"""Session settings, the shared folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings results depend on.
RUNTIME_SETTINGS = {"spark.sql.session.timeZone": "UTC"}
# Whether an execution removes its shuffle files when it ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "factorloom", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the plans rely on; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Call-site capture per column expression slows wide models down.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **RUNTIME_SETTINGS,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session someone else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    A temporary folder stands in only for an unset value on a local master.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if not named:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="factorloom-")
        context.setCheckpointDir(named)
        current = context.getCheckpointDir()
    return named or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _own_shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is executed in here leaves no shuffle files behind.

    Without it they stay until the driver happens to collect its garbage, so the steps of a chain
    add up on the executors' disks.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Used where a frame feeds several branches: the branches read one result, each only the
    columns it needs, with true sizes for join planning, and a lost executor costs a re-read
    instead of the whole upstream plan.  The shuffle files of the writing job go with it.
    """
    path = scratch_path(df.sparkSession, name)
    with _own_shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; stops counting just above the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_bytes: int = 8 << 20) -> DataFrame:
    """A side expected to be small: stored once, then broadcast if its files are.

    Above the bound the plain table is returned and the join stays a shuffle join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "side")
    with _own_shuffles_dropped(spark):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    size = files.getContentSummary(folder).getLength()
    return F.broadcast(stored) if size <= max_bytes else stored
