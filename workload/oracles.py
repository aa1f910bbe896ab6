"""SQL that gives the same rows as each registered query."""

from __future__ import annotations

from workload.fixture_sql import AS_OF, OPEN_END, SCHEMA_NAME, text, with_fixtures
from workload.portable import NULLABLE_VALUES


def _escape(value: str) -> str:
    return (
        f"replace(replace(replace({value}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    )


def _row(*values: str) -> str:
    cells = " || ".join(
        f"'<td>' || coalesce({_escape(f'CAST({v} AS VARCHAR)')}, '') || '</td>'" for v in values
    )
    return f"'<tr valign=\"top\">' || {cells} || '</tr>'"


def _heading(*titles: str) -> str:
    return '<tr valign="top">' + "".join(f"<th>{t}</th>" for t in titles) + "</tr>"


def _lines(rows: str, by: str, order: str, line: str, name: str) -> str:
    """Every line of a group with its position; ``line`` is an expression over ``rows``."""
    return f"""
        SELECT {by}, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS position,
               {line} AS {name}
        FROM {rows}"""


def _report(rows: str, order: str, line: str, lead: str, *titles: str) -> str:
    head = f'<html><body>{lead}<br/><br/><table border="1">' + _heading(*titles)
    return f"""
        SELECT server, 2 AS section, position, line
        FROM ({_lines(rows, "server", order, line, "line")}) AS numbered
        UNION ALL SELECT DISTINCT server, 1, 0, '{head}' FROM {rows}
        UNION ALL SELECT DISTINCT server, 3, 0, '</table></body></html>' FROM {rows}"""


def _clock(seconds: str) -> str:
    part = f"(({seconds}) % 86400)"
    return (
        f"lpad(CAST({part} // 3600 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST({part} // 60 % 60 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST({part} % 60 AS VARCHAR), 2, '0')"
    )


def _seconds(duration: str) -> str:
    return (
        f"CAST(({duration}) // 10000 * 3600 + ({duration}) // 100 % 100 * 60 "
        f"+ ({duration}) % 100 AS BIGINT)"
    )


_UNIFORM_CODE = """CASE {0} WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3
                   WHEN 4 THEN 2 ELSE 4 END"""
_UNIFORM_LABEL = """CASE {0} WHEN 0 THEN 'Failed' WHEN 1 THEN 'Success' WHEN 2 THEN 'In Progress'
                    WHEN 3 THEN 'Canceled' WHEN 4 THEN 'In Progress' ELSE 'Unknown' END"""
_RUNNING_CODE = """CASE {0} WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 1
                   WHEN 5 THEN 1 WHEN 7 THEN 2 END"""
_RUNNING_LABEL = """CASE {0} WHEN 0 THEN 'Completed / Not Started' WHEN 1 THEN 'In Progress'
                    WHEN 2 THEN 'In Progress' WHEN 3 THEN 'Retrying'
                    WHEN 4 THEN 'Completed / Not Started' WHEN 5 THEN 'Completed / Not Started'
                    WHEN 7 THEN 'In Progress' ELSE 'Unknown' END"""
_OUTCOME = """CASE {0} WHEN 0 THEN 'Failed' WHEN 1 THEN 'Success' WHEN 3 THEN 'Canceled'
              ELSE 'Unknown' END"""
_BACKUP_LABEL = """CASE {0} WHEN 'D' THEN 'Full Backup' WHEN 'I' THEN 'Differential'
                   WHEN 'L' THEN 'Transactional Log' ELSE 'Other' END"""

_NEVER = "coalesce(l.job_start, TIMESTAMP '1900-01-01 00:00:00')"
_DURATION = "coalesce(l.duration_seconds, 0)"

_STATUS_ROWS = f"""
    SELECT e.server, e.job_id, j.name AS job_name, {text(_NEVER)} AS job_start,
           {_clock(_DURATION)} AS job_duration, {_DURATION} AS duration_seconds, e.current_step,
           CASE WHEN e.running <> 0 THEN {_RUNNING_CODE.format("e.job_state")}
                ELSE s.last_run_outcome END AS run_status,
           CASE WHEN e.running <> 0 THEN {_RUNNING_LABEL.format("e.job_state")}
                ELSE {_OUTCOME.format("s.last_run_outcome")} END AS run_status_desc,
           CASE WHEN j.enabled = 1 THEN 'Enabled' ELSE 'Disabled' END AS is_enabled
    FROM job_listing e JOIN jobs j ON e.server = j.server AND e.job_id = j.job_id
         LEFT JOIN job_servers s ON e.server = s.server AND e.job_id = s.job_id
         LEFT JOIN latest_activity l ON e.server = l.server AND e.job_id = l.job_id"""

_STEP_OUTER = """
    SELECT s.server, s.job_id, s.step_id, s.step_name, h.instance_id, h.run_status, h.message,
           h.step_start, h.run_duration
    FROM job_steps s
         LEFT JOIN (SELECT p.*, strptime(CAST(p.run_date AS VARCHAR)
                               || lpad(CAST(p.run_time AS VARCHAR), 6, '0'), '%Y%m%d%H%M%S')
                               AS step_start
                    FROM job_past p) AS h
             ON h.server = s.server AND h.job_id = s.job_id AND h.step_id = s.step_id
            AND h.step_start >= (SELECT date_trunc('minute', max(a.job_start)
                                        + INTERVAL 30 SECOND)
                                 FROM latest_activity a
                                 WHERE a.server = s.server AND a.job_id = s.job_id)"""

_STEP_ROWS = f"""
    SELECT o.server, o.job_id, j.name AS job_name,
           'Step ' || CAST(o.step_id AS VARCHAR) || '. ' || o.step_name AS step_name,
           o.instance_id,
           CASE WHEN o.instance_id IS NULL THEN 4
                ELSE {_UNIFORM_CODE.format("o.run_status")} END AS run_status,
           coalesce(CASE WHEN o.instance_id IS NULL THEN NULL
                         WHEN {_UNIFORM_CODE.format("o.run_status")} IN (0, 3) THEN o.message
                         ELSE {_UNIFORM_LABEL.format("o.run_status")} END, 'Unknown status')
               AS run_status_desc,
           {text("o.step_start")} AS step_start,
           {_clock(_seconds("o.run_duration % 240000"))} AS step_duration,
           {_seconds("o.run_duration")} AS duration_seconds
    FROM ({_STEP_OUTER}) AS o
         JOIN job_listing e ON o.server = e.server AND o.job_id = e.job_id
         JOIN jobs j ON o.server = j.server AND o.job_id = j.job_id"""

_NEW_NAMES = """
    SELECT names.*, row_number() OVER (ORDER BY server, database_id) AS position FROM names"""

_LAST_RUN = """
    SELECT script_name, seq, coalesce(version_number, '1.0') AS version_number, author,
           object_name, description, option, is_error,
           CASE WHEN rtrim(error_message) <> '' THEN replace(error_message, '|', ' ') END
               AS error_message, release_date
    FROM offered_releases
    QUALIFY row_number() OVER (PARTITION BY lower(script_name) ORDER BY seq DESC) = 1"""

_COMPLETED_SETS = f"""
    SELECT t.server, t.set_id, coalesce(n.backup_set_id, t.backup_set_id) AS backup_set_id,
           CASE WHEN n.set_id IS NULL THEN t.database ELSE n.database_name END AS database,
           CASE WHEN n.set_id IS NULL THEN t.name ELSE n.name END AS name,
           CASE WHEN n.set_id IS NULL THEN t.first_lsn ELSE n.first_lsn END AS first_lsn,
           CASE WHEN n.set_id IS NULL THEN t.last_lsn ELSE n.last_lsn END AS last_lsn,
           {text("n.backup_start_date")} AS backup_start_date,
           {text("n.backup_finish_date")} AS backup_finish_date,
           CAST((n.backup_size + 1536) // 1024 AS BIGINT) AS size_kb,
           CASE WHEN n.set_id IS NULL THEN t.type
                ELSE {_BACKUP_LABEL.format("n.type")} END AS type,
           CASE WHEN n.set_id IS NULL THEN t.file_name ELSE n.file_name END AS file_name,
           CASE WHEN n.set_id IS NULL THEN t.recovery_model ELSE n.recovery_model END
               AS recovery_model,
           CASE WHEN n.set_id IS NULL THEN t.is_damaged ELSE n.is_damaged END AS is_damaged,
           CASE WHEN n.set_id IS NULL THEN t.machine ELSE n.server_name END AS machine,
           {text("t.create_datetime")} AS create_datetime
    FROM backup_sets t
         LEFT JOIN (SELECT DISTINCT c.server, c.set_id, c.file_name, b.*
                    FROM completions c
                         JOIN backupset b ON b.server_name = c.server
                                         AND b.backup_set_id = c.backup_set_id
                   ) AS n ON n.server = t.server AND n.set_id = t.set_id"""

_COLUMN_LINE = """
    '[' || column_name || '] ' ||
    CASE WHEN domain_name IS NOT NULL
         THEN domain_name || CASE WHEN is_nullable THEN ' NULL ' ELSE ' NOT NULL ' END
         ELSE upper(data_type)
              || CASE WHEN is_char THEN '(' || CASE WHEN max_length = -1 THEN 'MAX'
                      ELSE CAST(max_length AS VARCHAR) END || ')' ELSE '' END
              || CASE WHEN is_identity THEN ' IDENTITY(1000,1)' ELSE '' END
              || CASE WHEN is_nullable THEN ' NULL ' ELSE ' NOT NULL ' END
              || CASE WHEN default_name IS NOT NULL
                      THEN 'CONSTRAINT [' || default_name || '] DEFAULT' || upper(default_value)
                      ELSE '' END
    END || CASE WHEN ordinal = max(ordinal) OVER (PARTITION BY schema_name, table_name) THEN '' ELSE ',' END"""

_GRAPH_LEAD = (
    "--Note: Save this output as .xdl file and open in SSMS to view graphically "
    "and remove this line."
)
_GRAPH_BODY = f"replace(replace('{_GRAPH_LEAD}' || graph, '&#x0A;', ''), '&#x20;', '')"
_FAILURE_COLUMNS = (
    "instance_id, job_id, job_name, step_name, run_status, sql_message_id, sql_severity, "
    "message, exec_date, run_duration, server"
)
_TABLE = '<table class="incident" rules="all">'
_DETAIL_TITLES = (
    "currentdb", "nature", "waittime", "transactionname", "lock_mode", "status", "clientapp",
    "hostname", "loginname", "inputbuf",
)

_SELECTS = {
    "config_nodes_shred": """
        SELECT doc_id, "Server", "Instance", 'F:\\' || "Instance" AS "Backuplocation"
        FROM secondary""",
    "config_settings_pivot": """
        SELECT doc_id, c_mktsegment AS profile, c_name || '@example.com' AS address,
               CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id + 25 AS INTEGER) END AS port,
               CAST(doc_id % 2 AS INTEGER) AS ssl
        FROM config""",
    "template_text_render": """
        SELECT doc_id, 'USE [console] -- Collector.Events' || chr(10)
               || replace(replace(text, chr(65279), ''), 'the', 'conf.xml') AS script
        FROM documents""",
    "fleet_union_collect": """
        SELECT * EXCLUDE (ts, server),
               CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 'EAST'
                    WHEN ts < TIMESTAMP '2024-01-21 00:00:00' THEN 'NORTH'
                    ELSE 'WEST' END AS server
        FROM job_history_all""",
    "command_output_parse": "SELECT * FROM services",
    "failed_jobs_append": f"""
        SELECT * FROM recorded
        UNION ALL SELECT *, {AS_OF} FROM new_rows""",
    "blocked_events_store": """
        SELECT row_number() OVER (ORDER BY event_id) AS blocked_events_id, event_id,
               CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS INTEGER) END AS spid,
               report AS blocked_report, ts AS alert_datetime
        FROM events JOIN (SELECT event_id, report FROM blocked_reports) AS r USING (event_id)""",
    "deadlock_events_store": f"""
        SELECT row_number() OVER (ORDER BY doc_id) AS deadlock_events_id, doc_id,
               graph AS deadlock_graph, {AS_OF} AS alert_datetime
        FROM graphs""",
    "surrogate_key_assign": """
        SELECT (SELECT max(event_id) + 1000 FROM events
                WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
               + row_number() OVER (ORDER BY event_id) AS row_key,
               event_id, user_id, event_type
        FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""",
    "instance_monitored": """
        SELECT server_instance_id, server_name || '\\' || instance_name AS sql_instance,
               backup_location, primary_console
        FROM instances WHERE is_monitored""",
    "instance_pending_install": f"""
        SELECT server_instance_id, server_name || '\\' || instance_name AS sql_instance,
               backup_location
        FROM instances
        WHERE is_monitored AND NOT primary_console AND installed = {OPEN_END}""",
    "backup_candidates": "SELECT * FROM candidates",
    "status_code_map": f"""
        SELECT instance_id,
               CASE run_status WHEN 0 THEN 'Failed' WHEN 1 THEN 'Succeeded' WHEN 2 THEN 'Retry'
                    WHEN 3 THEN 'Canceled' WHEN 4 THEN 'In progress' END AS history_label,
               {_UNIFORM_CODE.format("ran")} AS uniform_code,
               {_UNIFORM_LABEL.format("ran")} AS uniform_label,
               {_RUNNING_CODE.format("sql_severity % 9")} AS running_code,
               {_RUNNING_LABEL.format("sql_severity % 9")} AS running_label,
               {_OUTCOME.format("run_status")} AS outcome_label,
               {_BACKUP_LABEL.format("substr('DILX', step_id + 1, 1)")} AS backup_label
        FROM (SELECT *, CASE WHEN step_id <> 0 THEN run_status END AS ran
              FROM job_history) AS h""",
    "stopped_services": "SELECT * FROM stopped",
    "null_default_project": """
        SELECT event_id, position, coalesce(database_id, -1) AS database_id, nature, waittime,
               transactionname, lock_mode, status, clientapp, hostname, loginname, inputbuf
        FROM process_rows""",
    "failed_jobs_view": "SELECT * FROM view_rows",
    "backup_view": f"""
        SELECT h.history_id, h.set_id, s.backup_set_id, s.database, s.name, s.first_lsn,
               s.last_lsn, {text("s.backup_start_date")} AS backup_start_date,
               {text("s.backup_finish_date")} AS backup_finish_date, s.size_kb, s.type,
               s.file_name, s.recovery_model, s.is_damaged, s.machine, h.job_name, h.is_running,
               h.is_error, h.error_message, {text("h.process_start")} AS process_start,
               {text("h.process_finish")} AS process_finish,
               {text("h.create_datetime")} AS create_datetime, h.server
        FROM backup_history h
             JOIN backup_sets s ON h.server = s.server AND h.set_id = s.set_id""",
    "job_step_outer": f"""
        SELECT * REPLACE ({text("step_start")} AS step_start) FROM ({_STEP_OUTER}) AS o""",
    "failed_jobs_new": "SELECT * FROM new_rows",
    "release_pending": """
        SELECT seq AS list_id, script_name, object_name FROM offered_releases o
        WHERE NOT EXISTS (SELECT 1 FROM releases r
                          WHERE lower(r.script_name) = lower(o.script_name)
                            AND NOT r.is_error)""",
    "existence_semi_join": """
        SELECT o_orderkey AS profile_id, o_orderpriority AS profile_name
        FROM orders
        WHERE EXISTS (SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                      WHERE l_orderkey = o_orderkey AND s_acctbal > 8000)""",
    "database_name_lookup": """
        SELECT event_id, position, database_id, currentdb FROM named_processes""",
    "lateral_derive": "SELECT * FROM service_levels",
    "catalog_column_profile": "SELECT * FROM profile",
    "recipients_concat": _lines(
        "(SELECT c_nationkey AS team, c_custkey, c_name FROM customer WHERE c_acctbal > 0)",
        "team", "c_custkey", "lower(c_name || '@Example.com')", "recipient",
    ),
    "backup_latest_set": """
        SELECT server_name, database_name, type, max(backup_set_id) AS backup_set_id
        FROM backupset GROUP BY server_name, database_name, type""",
    "backup_verify_missing": """
        SELECT server, set_id, database, backup_type,
               'No backup is on record for ' || database AS message
        FROM tracked t
        WHERE NOT EXISTS (SELECT 1 FROM backupset b
                          WHERE b.server_name = t.server AND b.type = t.backup_type
                            AND lower(b.database_name) = lower(t.database))""",
    "backup_latest_history": f"""
        SELECT * REPLACE ({text("process_finish")} AS process_finish) FROM latest_history""",
    "catalog_key_columns": "SELECT * FROM key_columns",
    "new_row_guard": "SELECT server, count(*) AS new_rows FROM new_rows GROUP BY server",
    "latest_activity_per_job": f"""
        SELECT j.server, j.job_id, {text(_NEVER)} AS job_start, {_clock(_DURATION)} AS job_duration,
               {_DURATION} AS duration_seconds
        FROM jobs j
             LEFT JOIN latest_activity l ON j.server = l.server AND j.job_id = l.job_id""",
    "current_jobs_status": _STATUS_ROWS,
    "current_job_steps": _STEP_ROWS,
    "current_jobs_all": f"""
        SELECT server, job_name, NULL AS step_name, current_step, run_status, run_status_desc,
               job_start AS started, job_duration AS duration, is_enabled, 'Job-Level' AS level
        FROM ({_STATUS_ROWS}) AS by_job
        UNION
        SELECT server, job_name, step_name, NULL, run_status, run_status_desc, step_start,
               step_duration, NULL, 'Step-Level'
        FROM ({_STEP_ROWS}) AS by_step""",
    "instance_topology_union": """
        SELECT doc_id, "Server", c_name AS "Instance", 'F:\\' || c_name AS "Backuplocation"
        FROM config
        UNION
        SELECT doc_id, "Server", "Instance", 'F:\\' || "Instance" FROM secondary""",
    "release_upsert": f"""
        SELECT r.release_id,
               CASE WHEN n.script_name IS NULL THEN r.version_number ELSE n.version_number END
                   AS version_number,
               r.script_name, coalesce(n.author, r.author) AS author,
               coalesce(n.object_name, r.object_name) AS object_name,
               coalesce(n.description, r.description) AS description,
               coalesce(n.option, r.option) AS option,
               coalesce(n.is_error, r.is_error) AS is_error,
               CASE WHEN n.script_name IS NULL THEN r.error_message ELSE n.error_message END
                   AS error_message,
               coalesce(n.release_date, r.release_date) AS release_date, r.installed,
               CASE WHEN n.script_name IS NULL THEN r.updated ELSE {AS_OF} END AS updated
        FROM releases r LEFT JOIN ({_LAST_RUN}) AS n ON lower(n.script_name) = lower(r.script_name)
        UNION ALL
        SELECT (SELECT max(release_id) FROM releases) + row_number() OVER (ORDER BY seq),
               version_number, script_name, author, object_name, description, option, is_error,
               error_message, release_date, {AS_OF}, {AS_OF}
        FROM ({_LAST_RUN}) AS n
        WHERE lower(script_name) NOT IN (SELECT lower(script_name) FROM releases)""",
    "instance_register": f"""
        SELECT server_name, instance_name, backup_location, primary_console, is_monitored,
               {text("installed")} AS installed, create_date
        FROM instances
        UNION ALL
        SELECT server_name, instance_name, min(backup_location), false, true,
               {text(OPEN_END)}, '2024-01-15'
        FROM (SELECT upper(trim(server_name)) AS server_name,
                     upper(trim(instance_name)) AS instance_name, backup_location
              FROM offered_instances) AS o
        WHERE NOT EXISTS (SELECT 1 FROM instances i
                          WHERE upper(i.server_name) = o.server_name
                            AND upper(i.instance_name) = o.instance_name)
        GROUP BY server_name, instance_name""",
    "instance_primary_flag": f"""
        SELECT server_instance_id, server_name, instance_name, backup_location,
               primary_console OR hit AS primary_console, is_monitored,
               {text(f"CASE WHEN hit THEN {AS_OF} ELSE installed END")} AS installed, create_date
        FROM (SELECT *, upper(server_name || '\\' || instance_name)
                        = 'NATION_19\\CUSTOMER#000000001' AS hit
              FROM instances) AS i""",
    "backup_start": f"""
        SELECT (SELECT max(set_id) FROM backup_sets) + position AS set_id,
               CAST(0 AS BIGINT) AS backup_set_id, database,
               (SELECT max(history_id) FROM backup_history) + position AS history_id, job_name, server,
               CAST(NULL AS VARCHAR) AS error_message,
               true AS is_running, false AS is_error, {text(AS_OF)} AS process_start,
               {text(OPEN_END)} AS process_finish, {text(AS_OF)} AS create_datetime
        FROM ({_NEW_NAMES}) AS n""",
    "backup_complete": f"""
        SELECT h.server, h.set_id, h.history_id, CASE WHEN c.set_id IS NULL THEN h.is_running ELSE false END
                   AS is_running,
               CASE WHEN c.set_id IS NULL THEN h.is_error ELSE false END AS is_error,
               CASE WHEN c.set_id IS NULL THEN h.error_message END AS error_message,
               {text(f"CASE WHEN c.set_id IS NULL THEN h.process_finish ELSE {AS_OF} END")}
                   AS process_finish,
               s.* EXCLUDE (server, set_id)
        FROM backup_history h
             LEFT JOIN (SELECT DISTINCT server, set_id FROM completions) AS c
                    ON c.server = h.server AND c.set_id = h.set_id
             LEFT JOIN ({_COMPLETED_SETS}) AS s ON s.server = h.server AND s.set_id = h.set_id""",
    "backup_fail": f"""
        SELECT h.server, h.history_id, h.set_id, h.job_name,
               h.is_running AND f.set_id IS NULL AS is_running,
               h.is_error OR f.set_id IS NOT NULL AS is_error,
               coalesce(f.message, h.error_message) AS error_message,
               {text("h.process_start")} AS process_start,
               {text(f"CASE WHEN f.set_id IS NULL THEN h.process_finish ELSE {AS_OF} END")}
                   AS process_finish,
               {text("h.create_datetime")} AS create_datetime
        FROM backup_history h
             LEFT JOIN (SELECT DISTINCT * FROM failures) AS f
                    ON f.server = h.server AND f.set_id = h.set_id""",
    "backup_retention": """
        SELECT 'history' AS table_name, server, history_id AS row_id, create_datetime
        FROM backup_history WHERE CAST(create_datetime AS DATE) > DATE '2024-01-11'
        UNION ALL
        SELECT 'sets', server, set_id, create_datetime
        FROM backup_sets WHERE CAST(create_datetime AS DATE) > DATE '2024-01-11'""",
    "backup_plan": "SELECT * FROM plan_rows",
    "backup_names": "SELECT * FROM names",
    "failed_jobs_report": _report(
        "new_rows",
        "instance_id",
        _row(
            "job_name", "step_name", "sql_message_id", "sql_severity", "message",
            "strftime(exec_date, '%Y-%m-%d %H:%M:%S')", "run_duration",
        ),
        "Job steps that failed, as of 2024-01-15 13:30:00",
        "Job Name", "Step Name", "SQL Message Id", "SQL Severity", "Message",
        "Execution Datetime", "Run Duration",
    ),
    "stopped_services_report": _report(
        "stopped",
        "name, row_id",
        _row("status", "name", "service_name"),
        "Watched services that do not run, as of 2024-01-15 13:30:00",
        "Status", "Service", "DisplayName",
    ),
    "blocked_process_details": "SELECT * FROM details",
    "blocked_report_render": f"""
        SELECT r.event_id,
               '{_TABLE}{_heading(*_DETAIL_TITLES)}' || coalesce(t.lines, '')
               || '</table>{_TABLE}<tr><th>Report</th></tr><tr><td>'
               || {_escape("r.report")} || '</td></tr></table>' AS body
        FROM blocked_reports r
             LEFT JOIN (SELECT event_id, string_agg({_row(*_DETAIL_TITLES)}, ''
                                                    ORDER BY position) AS lines
                        FROM details GROUP BY event_id) AS t ON t.event_id = r.event_id""",
    "deadlock_text_normalise": f"SELECT doc_id, {_GRAPH_BODY} AS body FROM graphs",
    "catalog_table_script": f"""
        SELECT schema_name, table_name, section, CAST(0 AS BIGINT) AS position, '' AS item,
               CASE section WHEN 1 THEN 'CREATE TABLE console.' || schema_name || '.' || table_name
                            WHEN 2 THEN '('
                    ELSE ')' END AS line
        FROM (SELECT DISTINCT schema_name, table_name FROM profile) AS t
             CROSS JOIN (VALUES (1), (2), (7)) AS s(section)
        UNION ALL
        SELECT schema_name, table_name, 3, ordinal, column_name, {_COLUMN_LINE} FROM profile
        UNION ALL
        SELECT schema_name, table_name, 4, 0, key_name,
               ',CONSTRAINT [' || key_name || '] FOREIGN KEY (' || plain_columns
               || ') REFERENCES [' || referenced_table || '](' || referenced_columns || ')'
        FROM key_columns WHERE kind = 'FK'
        UNION ALL
        SELECT {SCHEMA_NAME}, p_brand, 5, 0, 'ck_' || CAST(p_partkey AS VARCHAR),
               ',CONSTRAINT [ck_' || CAST(p_partkey AS VARCHAR) || '] CHECK ([col_'
               || CAST(p_partkey AS VARCHAR) || ']>(0))'
        FROM part WHERE p_size = 11
        UNION ALL
        SELECT schema_name, table_name, 6, 0, key_name,
               ',CONSTRAINT ' || key_name
               || CASE WHEN kind = 'PK' AND is_clustered THEN ' PRIMARY KEY  CLUSTERED '
                       WHEN kind = 'PK' THEN ' PRIMARY KEY  NONCLUSTERED '
                       WHEN is_clustered THEN ' UNIQUE ' ELSE ' UNIQUE  NONCLUSTERED ' END
               || '(' || key_columns || ')'
        FROM key_columns WHERE kind IN ('PK', 'UQ')
        UNION ALL
        SELECT schema_name, table_name, 8, 0, key_name,
               'CREATE ' || CASE WHEN is_clustered THEN 'CLUSTERED' ELSE 'NONCLUSTERED' END
               || ' INDEX [' || key_name || '] ON [' || table_name || '] (' || key_columns || ')'
        FROM key_columns WHERE kind = 'IX'""",
    "placement_violations": """
        SELECT 'Configuration' AS schema_name, p_brand AS table_name,
               'ix_' || CAST(p_partkey AS VARCHAR) AS index_name,
               CAST(p_partkey % 6 AS INTEGER) AS data_space_id, r_name AS data_space
        FROM part LEFT JOIN region ON r_regionkey = p_partkey % 6
        WHERE p_size % 2 = 0 AND p_partkey % 6 <> 0""",
    "key_constraint_audit": """
        SELECT server_name, instance_name, count(*) AS n_rows,
               CASE WHEN instance_name IS NULL THEN 'missing' ELSE 'duplicate' END AS problem
        FROM (SELECT upper(trim(server_name)) AS server_name,
                     nullif(upper(trim(instance_name)), 'CUSTOMER#000000003') AS instance_name
              FROM offered_instances) AS o
        GROUP BY server_name, instance_name
        HAVING count(*) > 1 OR instance_name IS NULL""",
    "foreign_key_audit": """
        SELECT server, history_id, set_id, job_name, is_running, is_error FROM backup_history h
        WHERE NOT EXISTS (SELECT 1 FROM backup_sets s
                          WHERE s.server = h.server AND s.set_id = h.set_id)""",
    "stream_failed_jobs": f"""
        SELECT {_FAILURE_COLUMNS}, create_datetime FROM recorded
        UNION ALL SELECT {_FAILURE_COLUMNS}, {AS_OF} FROM failed_rows f
        WHERE NOT EXISTS (SELECT 1 FROM recorded r
                          WHERE r.server = f.server AND r.instance_id = f.instance_id)""",
    "stream_blocked_events": """
        SELECT d.*, k.blocked_events_id, k.blocked_report, k.alert_datetime,
               CASE WHEN d.event_id % 7 <> 0 THEN CAST(k.user_id AS INTEGER) END AS spid
        FROM details d
             JOIN (SELECT e.event_id, e.user_id, r.report AS blocked_report, e.ts AS alert_datetime,
                          row_number() OVER (ORDER BY e.event_id) AS blocked_events_id
                   FROM events e JOIN blocked_reports r ON r.event_id = e.event_id) AS k
             ON k.event_id = d.event_id""",
    "stream_deadlock_events": f"""
        SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS deadlock_events_id,
               graph AS deadlock_graph, {AS_OF} AS alert_datetime, {_GRAPH_BODY} AS body
        FROM graphs""",
    "agent_datetime_decode": f"""
        SELECT instance_id, CASE WHEN instance_id % 100 = 0 THEN 0 ELSE run_date END AS run_date,
               run_time,
               CASE WHEN instance_id % 100 <> 0 THEN {text("date_trunc('second', ts)")} END
                   AS exec_date
        FROM job_history_all""",
    "hhmmss_duration_decode": f"""
        SELECT instance_id, run_duration, {_clock(_seconds("run_duration % 240000"))} AS wrapped,
               {_seconds("run_duration")} AS seconds
        FROM job_history""",
}

# Other ways to the same rows.
_SELECTS["failed_jobs_new_sketched"] = _SELECTS["failed_jobs_new"]
_SELECTS["latest_activity_polled"] = _SELECTS["latest_activity_per_job"]


def _with_texts(name: str, select: str) -> str:
    names = NULLABLE_VALUES.get(name)
    if not names:
        return select
    texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in names)
    return f"SELECT * REPLACE ({texts}) FROM ({select}) AS result"


ORACLES = {
    name: with_fixtures(_with_texts(name, select)) for name, select in _SELECTS.items()
}
