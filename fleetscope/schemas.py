"""Declared schemas of the stored tables and the fixed code sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# Fixed value: the "not yet" date that open rows carry instead of NULL.
OPEN_END = dt.datetime(2999, 12, 31)
# Fixed value: the start reported for a job that has never run.
NEVER_STARTED = dt.datetime(1900, 1, 1)

# Ids and names are unique per server only: every table collected from servers has the column
# ``server``, and every join of such tables compares it.
DDL = {
    "job_history": """
        instance_id bigint, job_id bigint, step_id int, run_status int,
        run_date int, run_time int, run_duration int, sql_message_id int,
        sql_severity int, message string, server string""",
    "jobs": "job_id bigint, name string, enabled int, server string",
    "job_steps": "job_id bigint, step_id int, step_name string, server string",
    "job_activity": "job_id bigint, start timestamp_ntz, stop timestamp_ntz, server string",
    "job_listing": "job_id bigint, running int, current_step int, job_state int, server string",
    "job_servers": "job_id bigint, last_run_outcome int, server string",
    "failed_jobs": """
        instance_id bigint, job_id bigint, job_name string, step_name string,
        run_status string, sql_message_id int, sql_severity int,
        message string, exec_date timestamp_ntz, run_duration int,
        server string, create_datetime timestamp_ntz""",
    "service_lines": "server string, row_id bigint, value string",
    "blocked_reports": "event_id bigint, alert timestamp_ntz, report string, server string",
    "blocked_events": """
        blocked_events_id bigint, event_id bigint, spid int,
        blocked_report string, alert_datetime timestamp_ntz""",
    "deadlock_docs": "doc_id bigint, graph string",
    "deadlock_events": """
        deadlock_events_id bigint, doc_id bigint, deadlock_graph string,
        alert_datetime timestamp_ntz""",
    "databases": """
        database_id bigint, name string, recovery_model int,
        is_read_only boolean, is_in_standby boolean, server string""",
    "backupset": """
        backup_set_id bigint, database_name string, name string, type string,
        first_lsn decimal(25,0), last_lsn decimal(25,0),
        backup_start_date timestamp_ntz, backup_finish_date timestamp_ntz,
        backup_size bigint, recovery_model string, is_damaged boolean,
        server_name string""",
    "backup_sets": """
        set_id bigint, backup_set_id bigint, database string, name string,
        first_lsn decimal(25,0), last_lsn decimal(25,0),
        backup_start_date timestamp_ntz, backup_finish_date timestamp_ntz,
        size_kb bigint, type string, file_name string, recovery_model string,
        is_damaged boolean, machine string, create_datetime timestamp_ntz,
        server string""",
    "backup_history": """
        history_id bigint, set_id bigint, job_name string, is_running boolean,
        is_error boolean, error_message string, process_start timestamp_ntz,
        process_finish timestamp_ntz, create_datetime timestamp_ntz, server string""",
    "instances": """
        server_instance_id string, server_name string, instance_name string,
        backup_location string, primary_console boolean, is_monitored boolean,
        installed timestamp_ntz, create_date date""",
    "releases": """
        release_id bigint, version_number decimal(3,1), script_name string,
        author string, object_name string, description string,
        option string, is_error boolean, error_message string,
        release_date date, installed timestamp_ntz, updated timestamp_ntz""",
    "alert_emails": "email_id bigint, name string, address string, is_active boolean",
}


def table_schema(name: str, partitions: str = "") -> T.StructType:
    """Schema of a stored table; ``partitions`` adds partition columns as DDL."""
    text = f"{DDL[name]}, {partitions}" if partitions else DDL[name]
    return T.StructType.fromDDL(text)


# --- Fixed values: status codes of the job scheduler and of backups ----------

HISTORY_LABEL = {0: "Failed", 1: "Succeeded", 2: "Retry", 3: "Canceled", 4: "In progress"}

UNIFORM_CODE = {0: 0, 1: 1, 2: 2, 3: 3, 4: 2}
UNIFORM_CODE_OTHER = 4
UNIFORM_LABEL = {0: "Failed", 1: "Success", 2: "In Progress", 3: "Canceled", 4: "In Progress"}

RUNNING_CODE = {0: 1, 1: 2, 2: 2, 3: 2, 4: 1, 5: 1, 7: 2}
RUNNING_LABEL = {
    0: "Completed / Not Started",
    1: "In Progress",
    2: "In Progress",
    3: "Retrying",
    4: "Completed / Not Started",
    5: "Completed / Not Started",
    7: "In Progress",
}

OUTCOME_LABEL = {0: "Failed", 1: "Success", 3: "Canceled"}

BACKUP_TYPE_LABEL = {"D": "Full Backup", "I": "Differential", "L": "Transactional Log"}
