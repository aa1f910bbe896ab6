"""Event feeds: failed jobs, blocking reports and deadlock graphs.

Each batch is written so that a repeated batch changes nothing: failed jobs by
the anti-join against what is recorded, incidents by one folder per batch.
No feed keeps operator state, so there is no watermark to lose late rows to, but for
``record_failed_jobs_bounded``, which never reads its record and pays with those rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions import clock
from fleetscope.operators import incidents, job_failures
from fleetscope.plans import failure_poll
from fleetscope.schemas import table_schema
from fleetscope.sinks import tables

BATCH = "batch"


def file_feed(
    spark: SparkSession, folder: str, schema, pattern: str = "*", files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files that arrive in a folder, as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def drain(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], state: str) -> None:
    """Process everything that has arrived, then stop. ``state`` holds the offsets."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def record_failed_jobs(
    history: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    location: str,
    state: str,
    as_of: dt.datetime,
) -> None:
    """Append the failures that are not recorded yet, whatever their day.

    A batch is compared with the partitions of its own days, all at once, so late rows and a
    backlog are kept.
    """
    spark = history.sparkSession
    tables.create_folder(spark, location)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        view = job_failures.failed_jobs_view(batch, jobs, steps, None)
        once = view.dropDuplicates(["server", "instance_id"]).persist()
        try:
            days = [r[0] for r in once.select(F.to_date("exec_date")).distinct().collect()]
            recorded = failure_poll.recorded_failures(batch.sparkSession, location, days)
            new = job_failures.failed_jobs_new(once, recorded, expected=once.count())
            failure_poll.record_failures(new, location, as_of)
        finally:
            once.unpersist()

    drain(history, on_batch, state)


def record_failed_jobs_bounded(
    history: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    location: str,
    state: str,
    as_of: dt.datetime,
    late_by: str,
) -> None:
    """Store each failure once without reading what is stored, one folder per batch.

    Repeats are known by the keys of the last ``late_by`` (as "2 days") of event time, which a
    state store holds; the state is bounded by the failures of that time. A failure that
    comes later than that is lost, as are rows without a time. A feed that starts
    over with new state needs a new location.
    """
    tables.create_folder(history.sparkSession, location)
    at = clock.agent_datetime(F.col("run_date"), F.col("run_time")).cast("timestamp")
    failed = history.filter(F.col("run_status") != job_failures.SUCCEEDED).withColumn("_at", at)
    once = (
        failed.filter(F.col("_at").isNotNull())
        .withWatermark("_at", late_by)
        .dropDuplicatesWithinWatermark(job_failures.FAILURE)
        .drop("_at")
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        view = job_failures.failed_jobs_view(batch, jobs, steps, None)
        _store_batch(job_failures.loaded_rows(view, as_of), location, batch_id)

    drain(once, on_batch, state)


def bounded_record(spark: SparkSession, location: str) -> DataFrame:
    """The failures that ``record_failed_jobs_bounded`` has stored."""
    return tables.open_table(spark, location, "failed_jobs", f"{BATCH} long").drop(BATCH)


def _store_batch(df: DataFrame, location: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{location}/{BATCH}={batch_id}")


def _next_key(spark: SparkSession, location: str, name: str, key: str, batch_id: int) -> int:
    """The key after the highest one of the batches before ``batch_id``.

    Batches are numbered without gaps and keys only grow, so the newest earlier
    batch that has rows decides; its folder is opened by name and no other one
    is listed, however many batches there are.
    """
    schema = table_schema(name)
    for number in range(batch_id - 1, -1, -1):
        if tables.is_committed(spark, location, BATCH, number):
            batch = spark.read.schema(schema).parquet(f"{location}/{BATCH}={number}")
            highest = batch.agg(F.max(key)).first()[0]
            if highest is not None:
                return highest + 1
    return 1


def record_blocked_events(
    reports: DataFrame, databases: DataFrame, events_at: str, details_at: str, state: str
) -> None:
    """Store each blocking report and its process details."""
    tables.create_folder(reports.sparkSession, events_at)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = incidents.with_processes(batch).persist()
        try:
            first = _next_key(
                batch.sparkSession, events_at, "blocked_events", "blocked_events_id", batch_id
            )
            stored = incidents.blocked_events_store(parsed, first=first)
            _store_batch(stored, events_at, batch_id)
            details = incidents.blocked_process_details(parsed, databases)
            _store_batch(details, details_at, batch_id)
        finally:
            parsed.unpersist()

    drain(reports, on_batch, state)


def record_deadlock_events(
    graphs: DataFrame, events_at: str, texts_at: str, state: str, as_of: dt.datetime
) -> None:
    """Store each deadlock graph and its normalised text."""
    tables.create_folder(graphs.sparkSession, events_at)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            first = _next_key(
                batch.sparkSession, events_at, "deadlock_events", "deadlock_events_id", batch_id
            )
            stored = incidents.deadlock_events_store(batch, as_of, first=first)
            _store_batch(stored, events_at, batch_id)
            _store_batch(incidents.deadlock_text_normalise(batch), texts_at, batch_id)
        finally:
            batch.unpersist()

    drain(graphs, on_batch, state)
