"""Failed job steps: what failed, what is new, what to report and keep."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import clock, codes
from fleetscope.operators import sketch
from fleetscope.operators.paging import html_report

SUCCEEDED = 1
FAILURE = ["server", "instance_id"]


def failed_jobs_view(
    history: DataFrame, jobs: DataFrame, steps: DataFrame, run_day: dt.date | None
) -> DataFrame:
    """Steps that did not succeed on ``run_day``, or on any day if it is None.

    The day is an equality on the stored ``run_date`` integer, so it reaches
    the scan. History rows without a catalogued step (job outcome rows, step
    0) drop out in the inner join. Jobs and steps are joined first, so the
    history is shuffled at most once.
    """
    of_day = F.lit(True) if run_day is None else F.col("run_date") == clock.day_number(run_day)
    failed = history.filter(of_day & (F.col("run_status") != SUCCEEDED))
    named_steps = steps.select("server", "job_id", "step_id", "step_name").join(
        jobs.select("server", "job_id", F.col("name").alias("job_name")), ["server", "job_id"]
    )
    return (
        failed.join(named_steps, ["server", "job_id", "step_id"])
        .select(
            "instance_id",
            "job_id",
            "job_name",
            "step_name",
            codes.history_label(F.col("run_status")).alias("run_status"),
            "sql_message_id",
            "sql_severity",
            "message",
            clock.agent_datetime(F.col("run_date"), F.col("run_time")).alias("exec_date"),
            "run_duration",
            "server",
        )
    )


def failed_jobs_new(
    view: DataFrame, recorded: DataFrame, expected: int | None = None
) -> DataFrame:
    """View rows that are not recorded yet.

    Ids are unique per server only, so the key is (server, instance_id).

    With ``expected``, about the number of view rows, a Bloom filter of their keys thins
    the record before it is shuffled, whatever its length. The view is
    read twice then, so it should be stored or cached.
    """
    known = recorded.select(*FAILURE)
    if expected is not None:
        known = sketch.may_match(known, view, FAILURE, expected)
    return view.join(known, FAILURE, "left_anti").select(*view.columns)


def loaded_rows(new: DataFrame, as_of: dt.datetime) -> DataFrame:
    """New failures with the time they were recorded."""
    return new.withColumn("create_datetime", clock.ntz(as_of))


def failed_jobs_append(new: DataFrame, recorded: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The recorded table after the new rows were added with their load time."""
    return recorded.unionByName(loaded_rows(new, as_of))


def new_row_guard(new: DataFrame) -> DataFrame:
    """Number of new rows per server; a server without any is not listed."""
    return new.groupBy("server").agg(F.count(F.lit(1)).alias("new_rows"))


def failed_jobs_report(
    new: DataFrame, as_of: dt.datetime, page_rows: int | None = None
) -> DataFrame:
    """Per server, an HTML table of the new failures in id order."""
    return html_report(
        new,
        "instance_id",
        ["server"],
        [
            ("Job Name", F.col("job_name")),
            ("Step Name", F.col("step_name")),
            ("SQL Message Id", F.col("sql_message_id")),
            ("SQL Severity", F.col("sql_severity")),
            ("Message", F.col("message")),
            ("Execution Datetime", clock.stamp(F.col("exec_date"))),
            ("Run Duration", F.col("run_duration")),
        ],
        f"Job steps that failed, as of {as_of:%Y-%m-%d %H:%M:%S}",
        page_rows,
    )
