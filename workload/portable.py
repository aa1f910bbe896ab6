"""Numbers and flags that may be NULL, compared as text.

Some tools give them another type as soon as a value is missing; the operators
themselves return integers and booleans.
"""

NULLABLE_VALUES = {
    "config_settings_pivot": ["port"],
    "blocked_events_store": ["spid"],
    "stream_blocked_events": ["spid"],
    "status_code_map": ["running_code"],
    "backup_view": ["size_kb"],
    "backup_complete": ["backup_set_id", "size_kb", "is_damaged"],
    "job_step_outer": ["instance_id", "run_status", "run_duration"],
    "current_jobs_status": ["run_status"],
    "current_job_steps": ["instance_id", "duration_seconds"],
    "current_jobs_all": ["current_step", "run_status"],
}
