"""The hourly backup decision and the processing of what servers report back."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fleetscope.operators import backups
from fleetscope.session import cut_lineage
from fleetscope.sinks import snapshots

SETS, HISTORY = "backup_sets", "backup_history"
CREATED = "create_datetime"


@dataclass
class Decision:
    names: DataFrame
    new_sets: DataFrame
    new_history: DataFrame


def decide(
    databases: DataFrame, history: DataFrame, sets: DataFrame, as_of: dt.datetime
) -> Decision:
    """What to run now, and the tracking rows to append before it runs."""
    plan = backups.backup_plan(databases, history, sets, as_of)
    names = cut_lineage(backups.backup_names(plan, as_of))
    return Decision(names, *backups.backup_start(names, sets, history, as_of))


def record(
    sets: DataFrame,
    history: DataFrame,
    completions: DataFrame,
    tracked: DataFrame,
    backupset: DataFrame,
    as_of: dt.datetime,
) -> tuple[DataFrame, DataFrame]:
    """Both tables after completions and missing backups were taken in.

    ``tracked`` (server, set_id, database, backup_type) are the backups that should
    exist by now.
    """
    failures = backups.backup_verify_missing(tracked, backupset).select(*backups.SET, "message")
    verified = completions.join(failures.select(*backups.SET), backups.SET, "left_anti")
    new_sets, closed = backups.backup_complete(sets, history, verified, backupset, as_of)
    return new_sets, backups.backup_fail(closed, failures, as_of)


# --- The same over stored tables ------------------------------------------------------


def stored_tables(spark: SparkSession, state: snapshots.Snapshot) -> tuple[DataFrame, DataFrame]:
    return snapshots.open_parts(spark, state, SETS), snapshots.open_parts(spark, state, HISTORY)


def run_decision(
    spark: SparkSession, location: str, databases: DataFrame, as_of: dt.datetime
) -> tuple[snapshots.Snapshot, DataFrame]:
    """Decide what to run and store its tracking rows in both tables, in one commit.

    Returns the snapshot and the names to run. Call it again after a ``Conflict``: it decides anew.
    """
    state = snapshots.current(spark, location)
    sets, history = stored_tables(spark, state)
    decision = decide(databases, history, sets, as_of)
    added = {SETS: decision.new_sets, HISTORY: decision.new_history}
    return snapshots.commit(spark, state, CREATED, added), decision.names


def run_record(
    spark: SparkSession,
    location: str,
    completions: DataFrame,
    tracked: DataFrame,
    backupset: DataFrame,
    as_of: dt.datetime,
) -> snapshots.Snapshot:
    """Take in completions and missing backups; both tables change in one commit.

    Only day folders with a set that is completed or missing are rewritten.
    """
    state = snapshots.current(spark, location)
    named = completions.select(*backups.SET).unionByName(tracked.select(*backups.SET))

    def rewritten(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
        both = record(parts[SETS], parts[HISTORY], completions, tracked, backupset, as_of)
        return dict(zip((SETS, HISTORY), both))

    return snapshots.change(spark, state, CREATED, {SETS: named, HISTORY: named}, backups.SET, rewritten)


def run_retention(
    spark: SparkSession, location: str, as_of: dt.datetime, days: int = backups.RETENTION_DAYS
) -> snapshots.Snapshot:
    """The daily deletion, of whole days in both tables at once. Rows kept are those of ``backups.backup_retention``."""
    state = snapshots.current(spark, location)
    first = None if days == backups.RESET else backups.first_day_kept(as_of, days)
    return snapshots.drop_days(spark, state, CREATED, first, (SETS, HISTORY))
