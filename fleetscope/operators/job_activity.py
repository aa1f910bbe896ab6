"""What the jobs of the fleet are doing now, per job and per step."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import clock, codes
from fleetscope.schemas import NEVER_STARTED

NEVER_RUN_CODE = 4
JOB = ["server", "job_id"]
STEP = [*JOB, "step_id"]


def latest_activity(activity: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Newest activity row per job: start and seconds until stop or ``as_of``.

    One aggregate with map-side combine, so a job with very many rows costs no
    more than others. Of two rows with the same start the longer one counts.
    """
    seconds = clock.seconds_between(
        F.col("start"), F.coalesce(F.col("stop"), clock.ntz(as_of))
    )
    started = activity.filter(F.col("start").isNotNull())
    newest = F.max(F.struct(F.col("start"), seconds.alias("seconds")))
    return started.groupBy(*JOB).agg(newest.alias("newest")).select(
        *JOB,
        F.col("newest.start").alias("job_start"),
        F.col("newest.seconds").alias("duration_seconds"),
    )


def newest_runs(activity: DataFrame) -> DataFrame:
    """The activity row of each job's newest start, with its latest stop if one is known."""
    started = activity.filter(F.col("start").isNotNull())
    newest = F.max(F.struct("start", "stop"))
    return started.groupBy(*JOB).agg(newest.alias("newest")).select(
        "job_id", F.col("newest.start").alias("start"), F.col("newest.stop").alias("stop"), "server"
    )


def latest_activity_per_job(
    jobs: DataFrame, activity: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """Every job with its newest start and duration, defaults if it never ran."""
    latest = latest_activity(activity, as_of)
    seconds = F.coalesce(F.col("duration_seconds"), F.lit(0))
    return jobs.select(*JOB).join(latest, JOB, "left").select(
        *JOB,
        F.coalesce("job_start", clock.ntz(NEVER_STARTED)).alias("job_start"),
        clock.wrapped_label(seconds).alias("job_duration"),
        seconds.cast("long").alias("duration_seconds"),
    )


def current_jobs_status(
    listing: DataFrame,
    jobs: DataFrame,
    servers: DataFrame,
    activity: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """Job-level status of every listed job.

    An idle job shows its last outcome, a running one its state. Sort by
    ``is_enabled`` descending and ``job_name`` for display.
    """
    running = F.col("running") != 0
    seconds = F.coalesce(F.col("duration_seconds"), F.lit(0))
    return (
        listing.join(jobs.select(*JOB, "name", "enabled"), JOB)
        .join(servers.select(*JOB, "last_run_outcome"), JOB, "left")
        .join(latest_activity(activity, as_of), JOB, "left")
        .select(
            *JOB,
            F.col("name").alias("job_name"),
            F.coalesce("job_start", clock.ntz(NEVER_STARTED)).alias("job_start"),
            clock.wrapped_label(seconds).alias("job_duration"),
            seconds.cast("long").alias("duration_seconds"),
            "current_step",
            F.when(running, codes.running_code(F.col("job_state")))
            .otherwise(F.col("last_run_outcome"))
            .alias("run_status"),
            F.when(running, codes.running_label(F.col("job_state")))
            .otherwise(codes.outcome_label(F.col("last_run_outcome")))
            .alias("run_status_desc"),
            F.when(F.col("enabled") == 1, "Enabled").otherwise("Disabled").alias("is_enabled"),
        )
    )


def job_step_outer(steps: DataFrame, history: DataFrame, activity: DataFrame) -> DataFrame:
    """Every step with its history rows since the start of the job's newest run.

    Steps that have not run since then are kept with empty history columns.
    The job start is rounded to the minute before the comparison, so a step
    started in a rounded-up half minute does not count.

    Further columns of ``steps`` are kept. History older than the oldest of
    these starts is left out by the stored day, which reaches the scan.

    A left join could not split a job that holds a large part of the history,
    since that side is the optional one. So the rows that match come from an
    inner join, which skew handling can split, and the steps without any are
    found by the time of their last run, which is combined map-side.
    """
    starts = activity.groupBy(*JOB).agg(
        clock.minute_round(F.max("start")).alias("counted_from")
    )
    oldest = F.min("counted_from")
    first_day = starts.agg(F.date_format(oldest, "yyyyMMdd").cast("int")).scalar()
    steps_due = steps.join(starts, JOB, "left")
    runs = history.filter(F.col("run_date") >= first_day).select(
        *STEP,
        "instance_id",
        "run_status",
        "message",
        clock.agent_datetime(F.col("run_date"), F.col("run_time")).alias("step_start"),
        "run_duration",
    )
    ran = steps_due.join(runs, STEP).filter(F.col("step_start") >= F.col("counted_from"))
    last_runs = runs.groupBy(*STEP).agg(F.max("step_start").alias("last_run"))
    has_run = F.coalesce(F.col("last_run") >= F.col("counted_from"), F.lit(False))
    never = steps_due.join(last_runs, STEP, "left").filter(~has_run)
    return ran.drop("counted_from").unionByName(
        never.drop("counted_from", "last_run"), allowMissingColumns=True
    )


def current_job_steps(
    listing: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    history: DataFrame,
    activity: DataFrame,
) -> DataFrame:
    """Step-level status of every listed job."""
    listed = (
        steps.select(*STEP, "step_name")
        .join(jobs.select(*JOB, F.col("name").alias("job_name")), JOB)
        .join(listing.select(*JOB), JOB)
    )
    has_run = F.col("instance_id").isNotNull()
    code = F.when(has_run, codes.uniform_code(F.col("run_status"))).otherwise(NEVER_RUN_CODE)
    text = F.when(
        has_run,
        F.when(code.isin(0, 3), F.col("message")).otherwise(
            codes.uniform_label(F.col("run_status"))
        ),
    )
    seconds = clock.hhmmss_seconds(F.col("run_duration"))
    wrapped = clock.hhmmss_seconds(F.col("run_duration") % 240000)
    return job_step_outer(listed, history, activity).select(
        *JOB,
        "job_name",
        F.concat(
            F.lit("Step "), F.col("step_id").cast("string"), F.lit(". "), F.col("step_name")
        ).alias("step_name"),
        "instance_id",
        code.alias("run_status"),
        F.coalesce(text, F.lit("Unknown status")).alias("run_status_desc"),
        "step_start",
        clock.wrapped_label(wrapped).alias("step_duration"),
        seconds.alias("duration_seconds"),
    )


def current_jobs_all(status: DataFrame, step_status: DataFrame) -> DataFrame:
    """Job-level and step-level rows in one result without duplicates."""
    nothing = F.lit(None)
    job_rows = status.select(
        "server",
        "job_name",
        nothing.cast("string").alias("step_name"),
        F.col("current_step").alias("current_step"),
        "run_status",
        "run_status_desc",
        F.col("job_start").alias("started"),
        F.col("job_duration").alias("duration"),
        "is_enabled",
        F.lit("Job-Level").alias("level"),
    )
    step_rows = step_status.select(
        "server",
        "job_name",
        "step_name",
        nothing.cast("int").alias("current_step"),
        "run_status",
        "run_status_desc",
        F.col("step_start").alias("started"),
        F.col("step_duration").alias("duration"),
        nothing.cast("string").alias("is_enabled"),
        F.lit("Step-Level").alias("level"),
    )
    return job_rows.unionByName(step_rows).distinct()
