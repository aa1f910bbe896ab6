"""One poll for failed jobs: find the new ones, record them, report them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.operators import job_failures
from fleetscope.operators.registry import recipients_concat
from fleetscope.session import cut_lineage
from fleetscope.sinks import tables

PARTITION = "exec_day"


@dataclass
class PollResult:
    new: DataFrame
    report: DataFrame
    recipients: DataFrame


def recorded_failures(
    spark, location: str, days: Sequence[dt.date | None] | None = None
) -> DataFrame:
    """The recorded failures, of some execution days or of all."""
    if days is not None:
        return tables.open_partitions(spark, location, "failed_jobs", PARTITION, days)
    return tables.open_table(spark, location, "failed_jobs", f"{PARTITION} date").drop(PARTITION)


def record_failures(new: DataFrame, location: str, as_of: dt.datetime) -> None:
    """Append new failures, laid out by execution day."""
    rows = job_failures.loaded_rows(new, as_of).withColumn(PARTITION, F.to_date("exec_date"))
    tables.append_rows(rows, location, [PARTITION])


def poll(
    history: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    emails: DataFrame,
    location: str,
    run_day: dt.date,
    as_of: dt.datetime,
) -> PollResult | None:
    """Record and report the failures of ``run_day`` not recorded so far.

    Only that day's partition of the record is read. Recording comes before
    reporting, so a failed run reports nothing twice. Without news, None.
    """
    spark = history.sparkSession
    recorded = recorded_failures(spark, tables.create_folder(spark, location), [run_day])
    view = cut_lineage(job_failures.failed_jobs_view(history, jobs, steps, run_day))
    new = cut_lineage(job_failures.failed_jobs_new(view, recorded, expected=view.count()))
    if new.isEmpty():
        return None
    record_failures(new, location, as_of)
    return PollResult(
        new, job_failures.failed_jobs_report(new, as_of), recipients_concat(emails)
    )
