"""The newest run of every job, kept up by polls instead of read from the whole activity.

The stored table has the columns of the activity and one row per job, laid out by the
day of its start. A poll merges the activity it collected: it opens the days that hold
a job of its rows, rewrites those and commits them as one snapshot. The merge is
a maximum, so a poll may be repeated, come late or overlap another one.

A run is known by its start, and once a poll saw its stop it has ended: a row of
the same start without one, from an earlier look at the run, does not open it again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from fleetscope.operators import job_activity
from fleetscope.session import cut_lineage
from fleetscope.sinks import snapshots

TABLE = "job_activity"


def merge_activity(activity: DataFrame, location: str) -> snapshots.Snapshot:
    """Merge collected activity into the table under ``location``.

    ``snapshots.Conflict`` if another poll has committed meanwhile; merge again then.
    """
    spark = activity.sparkSession
    snapshot = snapshots.current(spark, location)
    polled = cut_lineage(job_activity.newest_runs(activity))
    if polled.isEmpty():
        return snapshot
    days = snapshots.touched(spark, snapshot, TABLE, polled, job_activity.JOB)
    stored = snapshots.open_parts(spark, snapshot, TABLE, days)
    merged = job_activity.newest_runs(stored.unionByName(polled))
    return snapshots.commit(spark, snapshot, "start", {TABLE: merged}, {TABLE: days})


def newest_runs(spark: SparkSession, location: str) -> DataFrame:
    """One row of activity per job that ever ran."""
    return snapshots.open_parts(spark, snapshots.current(spark, location), TABLE)


def latest_activity_per_job(jobs: DataFrame, location: str, as_of: dt.datetime) -> DataFrame:
    """Every job with its newest start and duration at ``as_of``, from the stored table."""
    runs = newest_runs(jobs.sparkSession, location)
    return job_activity.latest_activity_per_job(jobs, runs, as_of)
