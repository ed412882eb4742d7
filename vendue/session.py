"""Session set-up and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest group a single task may sort. Larger groups take the split path of
# the operator concerned.
GROUP_ROWS = 250_000

# Bytes of input files for each shuffle partition, and of shuffled rows for each task.
PARTITION_BYTES = 2 << 20
TASK_BYTES = 16 << 20

# Largest frame that may be broadcast after its rows have been counted.
BROADCAST_ROWS = 200_000


def get_session(app: str = "vendue", **conf: str) -> SparkSession:
    """Session with the settings the operators expect (zone UTC, AQE, ANSI)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # checkpoints of frames that are no longer referenced go
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.compress", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files at a path; only their names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def scale_partitions(spark: SparkSession, size: int) -> None:
    """Shuffle partitions in proportion to ``size`` bytes of input, so that what a task holds does not grow with it.

    Adaptive execution joins small ones again, up to ``TASK_BYTES``.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, -(-size // PARTITION_BYTES))))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{TASK_BYTES}b")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the session names, else a local one in local mode.

    A cluster has to name a shared folder; a machine-local one would be lost
    together with the machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="vendue-checkpoint-")
    context.setCheckpointDir(named)
    return named


def pin(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint.

    Used where a frame is read more than once, or where a later step relies on
    the rows staying in the partitions they were numbered in.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
