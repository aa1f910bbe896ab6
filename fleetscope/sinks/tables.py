"""Stored Parquet tables with one writer.

Rows become visible only when their write has committed, so lost executors leave
no half-written state. A version also survives a driver that is lost while it
commits, since readers look for its success marker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fleetscope.schemas import table_schema

VERSION = "version"
# Fixed value: the folder that Spark writes rows without a partition value to.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def create_folder(spark: SparkSession, location: str) -> str:
    path, files = _path(spark, location)
    files.mkdirs(path)
    return location


def is_folder(spark: SparkSession, location: str) -> bool:
    path, files = _path(spark, location)
    return files.exists(path) and files.getFileStatus(path).isDirectory()


def open_table(
    spark: SparkSession, location: str, name: str, partitions: str = ""
) -> DataFrame:
    """The rows under ``location`` with the declared schema of table ``name``.

    ``partitions`` are the partition columns as DDL, if the table has any.
    """
    return spark.read.schema(table_schema(name, partitions)).parquet(location)


def open_partitions(
    spark: SparkSession, location: str, name: str, partition: str, values: Sequence[object]
) -> DataFrame:
    """The rows of some partitions, without listing the others; empty if there are none."""
    folders = [f"{location}/{partition}={NO_VALUE if v is None else v}" for v in values]
    present = [f for f in folders if _path(spark, f)[1].exists(_path(spark, f)[0])]
    if not present:
        return spark.createDataFrame([], table_schema(name))
    return spark.read.schema(table_schema(name)).parquet(*present)


def _laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by partition, a large one split over several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_rows(df: DataFrame, location: str, partition_by: Sequence[str] = ()) -> None:
    _laid_out(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(location)


def replace_partitions(df: DataFrame, location: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for.

    ``df`` may be computed from the table itself. Each partition is swapped
    when the job commits; partitions without rows in ``df`` stay.
    """
    (
        _laid_out(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(location)
    )


def touched_partitions(
    table: DataFrame, changes: DataFrame, key: Sequence[str], partition: str
) -> DataFrame:
    """The rows of all partitions in which ``changes`` has a key.

    A state change names few rows. Its operator is applied to this part of the
    table and the result goes to ``replace_partitions``; the rest is not read a
    second time and not rewritten.
    """
    key = list(key)
    hit = table.select(*key, partition).join(changes.select(*key), key, "left_semi")
    return table.join(hit.select(partition).distinct(), partition, "left_semi").select(
        *table.columns
    )


def is_committed(spark: SparkSession, location: str, label: str, number: int) -> bool:
    """Whether the folder ``label=<number>`` was written to the end."""
    marker, files = _path(spark, f"{location}/{label}={number}/_SUCCESS")
    return files.exists(marker)


def committed_numbers(spark: SparkSession, location: str, label: str) -> list[int]:
    """Numbers of the committed ``label=<n>`` folders, ascending.

    Folders without a success marker are remains of failed writes.
    """
    path, files = _path(spark, location)
    if not files.exists(path):
        return []
    numbers = []
    for status in files.listStatus(path):
        folder = status.getPath()
        name, _, number = folder.getName().partition("=")
        marker = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
        if name == label and files.exists(marker):
            numbers.append(int(number))
    return sorted(numbers)


def publish_version(df: DataFrame, location: str) -> int:
    """Write a whole new state beside the current one and return its number."""
    number = max(committed_numbers(df.sparkSession, location, VERSION), default=0) + 1
    df.write.mode("overwrite").parquet(f"{location}/{VERSION}={number}")
    return number


def current_version(spark: SparkSession, location: str, name: str) -> DataFrame:
    """The newest committed state, or an empty table."""
    numbers = committed_numbers(spark, location, VERSION)
    if not numbers:
        return spark.createDataFrame([], table_schema(name))
    schema = table_schema(name)
    return spark.read.schema(schema).parquet(f"{location}/{VERSION}={numbers[-1]}")
