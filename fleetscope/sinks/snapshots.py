"""Tables that change together, and by whole days.

A *snapshot* is a small file that names, for each table, the folders its rows
are in, one per day and write. A commit writes the new folders first and then
renames one file, the next snapshot, into place: readers see both tables before
the change or both after it. A driver that is lost before the rename leaves
folders that no snapshot names, which ``sweep`` deletes.

Each snapshot follows the one it was made from. If another writer has put its
own there meanwhile, the rename finds the name taken and the commit fails, and
nothing of it is seen. (Rename without overwriting is atomic on HDFS; a local file
system checks first and renames then.)

Appending writes the new rows only. A change rewrites the folders that have a row it
names. Days are dropped without opening a file.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.schemas import table_schema
from fleetscope.sinks.tables import NO_VALUE, _path

DAY = "day"
SNAPSHOTS = "snapshots"


class Conflict(RuntimeError):
    """Another writer has committed since the snapshot was read."""


@dataclass(frozen=True)
class Part:
    """A folder, relative to the location, with rows of one day; rows without a day have None."""

    folder: str
    day: dt.date | None


@dataclass(frozen=True)
class Snapshot:
    location: str
    number: int = 0
    parts: Mapping[str, tuple[Part, ...]] = field(default_factory=dict)

    def of(self, table: str) -> tuple[Part, ...]:
        return self.parts.get(table, ())


def current(spark: SparkSession, location: str) -> Snapshot:
    """The newest snapshot; number 0, without parts, if there is none."""
    path, files = _path(spark, f"{location}/{SNAPSHOTS}")
    numbers = [int(s.getPath().getName()) for s in files.listStatus(path) if s.getPath().getName().isdigit()] if files.exists(path) else []
    if not numbers:
        return Snapshot(location)
    newest, _ = _path(spark, f"{location}/{SNAPSHOTS}/{max(numbers)}")
    stream = files.open(newest)
    try:
        named = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    parts = {
        table: tuple(Part(folder, day and dt.date.fromisoformat(day)) for folder, day in rows)
        for table, rows in named.items()
    }
    return Snapshot(location, max(numbers), parts)


def open_parts(
    spark: SparkSession, snapshot: Snapshot, table: str, parts: Iterable[Part] | None = None
) -> DataFrame:
    """The rows of some parts of a table, or of all."""
    parts = snapshot.of(table) if parts is None else tuple(parts)
    if not parts:
        return spark.createDataFrame([], table_schema(table))
    folders = [f"{snapshot.location}/{p.folder}" for p in parts]
    return spark.read.schema(table_schema(table)).parquet(*folders)


def _write(rows: DataFrame, location: str, table: str, day_of: str) -> list[Part]:
    """New folders with the rows, one for each day."""
    spark = rows.sparkSession
    root = f"{table}/{uuid.uuid4().hex}"
    laid_out = rows.withColumn(DAY, F.to_date(day_of)).hint("rebalance", DAY)
    laid_out.write.partitionBy(DAY).parquet(f"{location}/{root}")
    path, files = _path(spark, f"{location}/{root}")
    days = [s.getPath().getName().partition("=") for s in files.listStatus(path) if s.isDirectory()]
    return [
        Part(f"{root}/{name}={day}", None if day == NO_VALUE else dt.date.fromisoformat(day))
        for name, _, day in sorted(days)
        if name == DAY
    ]


def commit(
    spark: SparkSession,
    snapshot: Snapshot,
    day_of: str,
    add: Mapping[str, DataFrame] | None = None,
    drop: Mapping[str, Iterable[Part]] | None = None,
) -> Snapshot:
    """The snapshot after ``snapshot``: rows added to some tables, and parts dropped from some.

    Rows go to the folder of the day in their column ``day_of``. ``Conflict`` if a snapshot of that number
    is there already; read the current one and make the change again.
    """
    add, drop = add or {}, drop or {}
    parts = {t: tuple(p for p in rows if p not in set(drop.get(t, ()))) for t, rows in snapshot.parts.items()}
    for table, rows in add.items():
        parts[table] = parts.get(table, ()) + tuple(_write(rows, snapshot.location, table, day_of))
    following = Snapshot(snapshot.location, snapshot.number + 1, parts)
    _put(spark, following)
    return following


def _put(spark: SparkSession, snapshot: Snapshot) -> None:
    named = {t: [(p.folder, p.day and p.day.isoformat()) for p in rows] for t, rows in snapshot.parts.items()}
    folder = f"{snapshot.location}/{SNAPSHOTS}"
    source, files = _path(spark, f"{folder}/.{uuid.uuid4().hex}")
    target, _ = _path(spark, f"{folder}/{snapshot.number}")
    stream = files.create(source)
    try:
        stream.write(json.dumps(named).encode())
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    keep_what_is_there = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(source), files.makeQualified(target), keep_what_is_there)
    except Exception as error:
        files.delete(source, False)
        if files.exists(target):
            raise Conflict(f"snapshot {snapshot.number} of {snapshot.location} was written by another") from error
        raise


def touched(
    spark: SparkSession, snapshot: Snapshot, table: str, changes: DataFrame, key: Iterable[str]
) -> list[Part]:
    """The parts of a table that have a row with a key of ``changes``; only key columns are read."""
    key = list(key)
    rows = open_parts(spark, snapshot, table)
    if not snapshot.of(table):
        return []
    place = F.regexp_extract("_metadata.file_path", rf"{table}/[0-9a-f]+/{DAY}=[^/]+", 0)
    hits = rows.select(*key, place.alias("folder")).join(changes.select(*key), key, "left_semi")
    found = {r[0] for r in hits.select("folder").distinct().collect()}  # folders, not rows
    return [p for p in snapshot.of(table) if p.folder in found]


def change(
    spark: SparkSession,
    snapshot: Snapshot,
    day_of: str,
    changes: Mapping[str, DataFrame],
    key: Iterable[str],
    rewritten: Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]],
) -> Snapshot:
    """Commit a state change of several tables.

    ``changes`` has, for each table, the keys of rows that change. ``rewritten`` gets the parts with such
    rows and returns them as they are from now on; all other parts stay as they are.
    """
    key = list(key)
    parts = {table: touched(spark, snapshot, table, keys, key) for table, keys in changes.items()}
    if not any(parts.values()):
        return snapshot
    after = rewritten({table: open_parts(spark, snapshot, table, hit) for table, hit in parts.items()})
    return commit(spark, snapshot, day_of, {t: after[t] for t, hit in parts.items() if hit}, parts)


def drop_days(
    spark: SparkSession, snapshot: Snapshot, day_of: str, first_kept: dt.date | None, tables: Iterable[str]
) -> Snapshot:
    """Commit the tables without days before ``first_kept``, or without any if it is None.

    The snapshot names the days, so no row is read and no file is opened. Rows without a day go too.
    """
    gone = {
        t: [p for p in snapshot.of(t) if first_kept is None or p.day is None or p.day < first_kept] for t in tables
    }
    if not any(gone.values()):
        return snapshot
    return commit(spark, snapshot, day_of, drop=gone)


def sweep(spark: SparkSession, location: str, keep: int = 2) -> int:
    """Delete folders that none of the newest ``keep`` snapshots names, and older snapshots. Number of folders.

    For the only writer, while no other one is about to commit.
    """
    newest = current(spark, location)
    path, files = _path(spark, f"{location}/{SNAPSHOTS}")
    if not newest.number:
        return 0
    kept = set()
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if not name.isdigit() or int(name) <= newest.number - keep:
            files.delete(status.getPath(), False)
            continue
        stream = files.open(status.getPath())
        try:
            named = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        kept |= {folder for rows in named.values() for folder, _ in rows}
    deleted = 0
    for table in newest.parts:
        for write in files.listStatus(_path(spark, f"{location}/{table}")[0]):
            left = 0
            for part in files.listStatus(write.getPath()):
                folder = f"{table}/{write.getPath().getName()}/{part.getPath().getName()}"
                if part.isDirectory() and folder not in kept:
                    files.delete(part.getPath(), True)
                    deleted += 1
                elif part.isDirectory():
                    left += 1
            if not left:
                files.delete(write.getPath(), True)
    return deleted
