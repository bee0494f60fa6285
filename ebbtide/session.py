"""Session defaults for local runs, and the shared scratch folder of a session."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
CLEAN_CHECKPOINTS = "spark.cleaner.referenceTracking.cleanCheckpoints"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ebbtide")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # No call-site record per column expression: it doubles plan-building time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, where every executor can write.

    Only a local session may go without the setting: it gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors"
            )
        folder = tempfile.mkdtemp(prefix="ebbtide-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
        if spark.conf.get(CLEAN_CHECKPOINTS, "false") != "true":
            log.warning("checkpoints stay on disk: %s is not true", CLEAN_CHECKPOINTS)
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark).rstrip('/')}/ebbtide-{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete all tables that :func:`stored` wrote; frames that read them become void."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_checked(small: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """``small`` for the right side of a join: sent to all tasks if it has at most
    ``most_rows`` rows, else joined like any other table."""
    small = pinned(small)
    return F.broadcast(small) if small.count() <= most_rows else small


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read from there from now on.

    Used where one result is read more than once and must be the same each time,
    even when executors are lost in between.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Like :func:`pinned`, as a Parquet table: keeps column pruning and statistics."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
