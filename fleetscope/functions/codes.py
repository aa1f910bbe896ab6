"""Code-to-label expressions built from the fixed code sets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope import schemas


def mapped(code: Column, code_set: Mapping, otherwise=None) -> Column:
    """One CASE over ``code_set``; a code outside it (or NULL) gives ``otherwise``."""
    result = None
    for key, value in code_set.items():
        result = F.when(code == key, F.lit(value)) if result is None else result.when(
            code == key, F.lit(value)
        )
    return result.otherwise(F.lit(otherwise))


def history_label(run_status: Column) -> Column:
    return mapped(run_status, schemas.HISTORY_LABEL)


def uniform_code(run_status: Column) -> Column:
    return mapped(run_status, schemas.UNIFORM_CODE, schemas.UNIFORM_CODE_OTHER)


def uniform_label(run_status: Column) -> Column:
    return mapped(run_status, schemas.UNIFORM_LABEL, "Unknown")


def running_code(job_state: Column) -> Column:
    return mapped(job_state, schemas.RUNNING_CODE)


def running_label(job_state: Column) -> Column:
    return mapped(job_state, schemas.RUNNING_LABEL, "Unknown")


def outcome_label(last_run_outcome: Column) -> Column:
    return mapped(last_run_outcome, schemas.OUTCOME_LABEL, "Unknown")


def backup_type_label(letter: Column) -> Column:
    return mapped(letter, schemas.BACKUP_TYPE_LABEL, "Other")
