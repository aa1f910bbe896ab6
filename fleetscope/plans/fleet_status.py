"""The status of every job and step of the fleet as one result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from fleetscope.operators import job_activity


def fleet_status(
    listing: DataFrame,
    jobs: DataFrame,
    servers: DataFrame,
    steps: DataFrame,
    history: DataFrame,
    activity: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """Each collected table is one frame for the whole fleet."""
    status = job_activity.current_jobs_status(listing, jobs, servers, activity, as_of)
    steps_now = job_activity.current_job_steps(listing, jobs, steps, history, activity)
    return job_activity.current_jobs_all(status, steps_now)
