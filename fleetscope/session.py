"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs a further shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Call sites are kept for error messages only and cost a stack walk per column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle sizing for a run over ``input_bytes`` on ``cores`` task slots.

    The number of partitions a shuffle starts with follows the data, so one
    partition fits a task's memory; adaptive execution merges those that turn
    out small and splits skewed ones.
    """
    partitions = max(2 * cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
    }


def build_session(master: str | None = None, **overrides: str) -> SparkSession:
    """A session with the settings the operators are tested under.

    ``overrides`` use double underscores for dots:
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName("fleetscope")
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master that names none;
    on a cluster a missing setting is an error, because executors could not
    read each other's files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file:" + tempfile.mkdtemp(prefix="fleetscope-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path under the working folder; it is not created yet."""
    return f"{working_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the working folder and read back.

    It is computed once, later readers take only the columns they need, and a
    lost executor costs no recomputation of what came before. The shuffle files
    of the computation are deleted with its end, since nobody reads them again. ``drop_cuts``
    deletes the rows when the results made from them are written.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark, "cut")
    write_and_forget(df, folder)
    _cuts.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def write_and_forget(df: DataFrame, folder: str) -> None:
    """``df`` as Parquet in a new folder; its shuffle files go as soon as it is written.

    Without this they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        # A frame decides about its shuffles when it is made, so this is a new one.
        df.select("*").write.parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)


_cuts: dict[str, list[str]] = {}


def drop_cuts(spark: SparkSession) -> int:
    """Delete what ``cut_lineage`` wrote so far and return the number of folders.

    For a caller whose results are written: frames made from a cut cannot be
    read any more.
    """
    folders = _cuts.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(folders)
