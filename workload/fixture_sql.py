"""The rules of ``fixtures`` as SQL common table expressions, by name."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-15 13:30:00'"
DAY_START = "TIMESTAMP '2024-01-15 00:00:00'"
DAY_END = "TIMESTAMP '2024-01-16 00:00:00'"
OPEN_END = "TIMESTAMP '2999-12-31 00:00:00'"

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"


BACKUP_TIME = "(ts - INTERVAL '15 days 10 hours 30 minutes')"
HISTORY_SET = f"CASE WHEN {K} = 13 THEN -(event_id // 5) - 1 ELSE event_id // 5 END"


SCHEMA_NAME = "CASE WHEN p_partkey % 4 = 0 THEN 'archive' ELSE 'dbo' END"


def server(key: str) -> str:
    return f"'SRV' || CAST({key} % 5 AS VARCHAR)"


def database_name(key: str) -> str:
    return f"'Customer#' || lpad(CAST({key} // 5 AS VARCHAR), 9, '0')"


TRACKED_NAME = (
    f"CASE WHEN event_id % 3 = 0 THEN upper({database_name('user_id')}) "
    f"ELSE {database_name('user_id')} END"
)


def without(value: str, word: str) -> str:
    return f"regexp_replace({value}, regexp_escape({word}), '', 'gi')"


def text(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S.%f')"


def letter(value: str) -> str:
    return f"CASE {value} WHEN 0 THEN 'D' WHEN 1 THEN 'I' ELSE 'L' END"


def brand_key(prefix: str) -> str:
    return f"'{prefix}' || CAST(p_partkey AS VARCHAR)"


def attribute(name: str, value: str) -> str:
    return (
        f"coalesce(' {name}=\"' || replace(replace(replace(CAST({value} AS VARCHAR), "
        "'&', '&amp;'), '<', '&lt;'), '\"', '&quot;') || '\"', '')"
    )


_SECONDS = "CAST(floor(value * 1000) AS BIGINT)"
_HOST = "'HOST' || CAST(event_id % 10 AS VARCHAR)"
_LOGIN = "'user<' || CAST(user_id AS VARCHAR) || '>'"

FIXTURES = {
    "job_history_all": f"""
        SELECT event_id AS instance_id, user_id // 5 AS job_id, {K} % 4 AS step_id,
               CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1
                               WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS run_status,
               CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS run_date,
               CAST(strftime(ts, '%H%M%S') AS INTEGER) AS run_time,
               CAST({_SECONDS} // 3600 * 10000 + {_SECONDS} // 60 % 60 * 100
                    + {_SECONDS} % 60 AS INTEGER) AS run_duration,
               {K} * 100 AS sql_message_id, {K} % 25 AS sql_severity, props AS message,
               {server("user_id")} AS server, ts
        FROM events""",
    "job_history": "SELECT * EXCLUDE (ts) FROM job_history_all",
    "job_past": f"SELECT * EXCLUDE (ts) FROM job_history_all WHERE ts <= {AS_OF}",
    "jobs": f"""
        SELECT c_custkey // 5 AS job_id, {server("c_custkey")} AS server, c_name AS name,
               CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS enabled
        FROM customer""",
    "job_steps": f"""
        SELECT c_custkey // 5 AS job_id, {server("c_custkey")} AS server, step_id,
               c_mktsegment || '_' || CAST(step_id AS VARCHAR) AS step_name
        FROM customer CROSS JOIN (VALUES (1), (2), (3)) AS s(step_id)""",
    "job_activity": f"""
        SELECT user_id // 5 AS job_id, {server("user_id")} AS server, ts AS start,
               CASE WHEN event_id % 5 <> 0
                    THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END AS stop
        FROM events WHERE ts <= {AS_OF} AND event_type = 'signup'""",
    "latest_activity": f"""
        SELECT server, job_id, start AS job_start,
               datesub('second', start, coalesce(stop, {AS_OF})) AS duration_seconds
        FROM job_activity
        QUALIFY row_number() OVER (PARTITION BY server, job_id
            ORDER BY start DESC, coalesce(stop, {AS_OF}) DESC) = 1""",
    "job_listing": f"""
        SELECT c_custkey // 5 AS job_id, {server("c_custkey")} AS server, CAST(c_custkey % 2 AS INTEGER) AS running,
               CAST(c_custkey % 4 AS INTEGER) AS current_step,
               CAST(c_custkey % 8 AS INTEGER) AS job_state
        FROM customer""",
    "job_servers": f"""
        SELECT c_custkey // 5 AS job_id, {server("c_custkey")} AS server,
               CASE c_nationkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 5
               END AS last_run_outcome
        FROM customer WHERE c_mktsegment <> 'FURNITURE'""",
    "failed_rows": f"""
        SELECT h.run_date, h.instance_id, h.job_id, j.name AS job_name, s.step_name,
               CASE h.run_status WHEN 0 THEN 'Failed' WHEN 2 THEN 'Retry'
                    WHEN 3 THEN 'Canceled' WHEN 4 THEN 'In progress' END AS run_status,
               h.sql_message_id, h.sql_severity, h.message,
               strptime(CAST(h.run_date AS VARCHAR) || lpad(CAST(h.run_time AS VARCHAR), 6, '0'),
                        '%Y%m%d%H%M%S') AS exec_date,
               h.run_duration, h.server
        FROM job_history h JOIN jobs j ON h.server = j.server AND h.job_id = j.job_id
             JOIN job_steps s ON h.server = s.server AND h.job_id = s.job_id
                             AND h.step_id = s.step_id
        WHERE h.run_status <> 1""",
    "view_rows": "SELECT * EXCLUDE (run_date) FROM failed_rows WHERE run_date = 20240115",
    "recorded": f"""
        SELECT *, {DAY_START} AS create_datetime FROM view_rows WHERE sql_severity < 8""",
    "new_rows": """
        SELECT * FROM view_rows v WHERE NOT EXISTS (
            SELECT 1 FROM recorded r
            WHERE r.server = v.server AND r.instance_id = v.instance_id)""",
    "service_lines": """
        SELECT CAST(n_nationkey AS VARCHAR) AS server, CAST(h.row_id AS BIGINT) AS row_id, h.value
        FROM nation CROSS JOIN (VALUES (1, ''), (2, 'Name Status DisplayName'),
                                       (3, '---- ------ ---')) AS h(row_id, value)
        UNION ALL
        SELECT server, row_id,
               CASE WHEN s_suppkey % 29 = 0 THEN NULL WHEN s_suppkey % 31 = 0 THEN name
                    ELSE name || '  ' || CASE WHEN s_suppkey % 2 = 0 THEN 'Running'
                         ELSE 'Stopped' END || '  SQL Server ('
                         || CASE WHEN s_suppkey % 7 = 0 THEN lower(name) ELSE name END || ')' END
        FROM (SELECT CAST(s_nationkey AS VARCHAR) AS server, s_suppkey + 4 AS row_id, s_suppkey,
                     CASE s_suppkey % 3 WHEN 0 THEN 'MSSQL$' WHEN 1 THEN 'SQLAGENT$'
                     ELSE 'SQLWriter' END || CAST(s_suppkey AS VARCHAR) AS name
              FROM supplier) AS s""",
    "service_name": """
        SELECT server, row_id, value, split_part(trim(value), ' ', 1) AS name
        FROM service_lines WHERE value IS NOT NULL AND row_id > 3""",
    "service_status": f"""
        SELECT *, split_part(trim(after_name), ' ', 1) AS status
        FROM (SELECT *, {without("value", "name")} AS after_name FROM service_name) AS a""",
    "service_levels": f"""
        SELECT *,
               trim({without(f"CASE WHEN status = '' THEN value ELSE {without('value', 'status')} END", "name")})
                   AS service_name,
               instr(trim(value), ' ') > 0 AND instr(trim(after_name), ' ') > 0 AS is_complete
        FROM service_status""",
    "services": """
        SELECT server, row_id, status, name, service_name
        FROM service_levels WHERE is_complete""",
    "stopped": """
        SELECT * FROM services WHERE upper(status) <> 'RUNNING'
           AND (upper(name) LIKE 'SQLAGENT%' OR upper(name) LIKE 'MSSQL%')""",
    "databases": f"""
        SELECT {server("c_custkey")} AS server, c_custkey // 5 + 1 AS database_id,
               {database_name("c_custkey")} AS name,
               CAST(c_custkey % 3 + 1 AS INTEGER) AS recovery_model,
               c_mktsegment = 'MACHINERY' AS is_read_only, c_nationkey = 0 AS is_in_standby
        FROM customer""",
    "process_rows": f"""
        SELECT event_id, {server("user_id")} AS server, 0 AS position, 'Blocked' AS nature,
               CAST({_SECONDS} AS VARCHAR) AS waittime,
               CASE WHEN event_id % 5 <> 0 THEN 'user_transaction' ELSE '' END
                   AS transactionname,
               CASE WHEN event_id % 2 <> 0 THEN 'X' ELSE '' END AS lock_mode,
               event_type AS status, 'app & co' AS clientapp,
               CASE WHEN event_id % 3 <> 0 THEN {_HOST} ELSE '' END AS hostname,
               {_LOGIN} AS loginname, user_id // 5 AS database_id, props AS inputbuf
        FROM events
        UNION ALL
        SELECT event_id, {server("user_id")}, 1, 'BlockedBy', '', '', '', 'running', '', {_HOST},
               CASE WHEN event_id % 11 <> 0 THEN {_LOGIN} ELSE '' END, user_id // 5 + 1,
               CASE WHEN event_id % 4 <> 0 THEN props ELSE '' END
        FROM events WHERE event_id % 7 <> 0""",
    "named_processes": """
        SELECT p.*, coalesce(b.name, '') AS currentdb
        FROM process_rows p
             LEFT JOIN databases b ON b.server = p.server AND b.database_id = p.database_id""",
    "details": """
        SELECT event_id, position, nature, waittime, transactionname, lock_mode, status,
               clientapp, hostname, loginname, currentdb, inputbuf
        FROM named_processes""",
    "blocked_reports": f"""
        SELECT event_id, ts AS alert,
               '<TextData><blocked-process-report><blocked-process><process'
               || {attribute("waittime", _SECONDS)}
               || {attribute("transactionname",
                             "CASE WHEN event_id % 5 <> 0 THEN 'user_transaction' END")}
               || {attribute("lockMode", "CASE WHEN event_id % 2 <> 0 THEN 'X' END")}
               || {attribute("status", "event_type")}
               || {attribute("clientapp", "'app & co'")}
               || {attribute("hostname", f"CASE WHEN event_id % 3 <> 0 THEN {_HOST} END")}
               || {attribute("loginname", _LOGIN)}
               || {attribute("currentdb", "user_id // 5")}
               || '><inputbuf>' || props || '</inputbuf></process></blocked-process>'
               || CASE WHEN event_id % 7 <> 0 THEN
                  '<blocking-process><process'
                  || {attribute("spid", "user_id")}
                  || {attribute("status", "'running'")}
                  || {attribute("hostname", _HOST)}
                  || {attribute("loginname", f"CASE WHEN event_id % 11 <> 0 THEN {_LOGIN} END")}
                  || {attribute("currentdb", "user_id // 5 + 1")}
                  || '>' || CASE WHEN event_id % 4 <> 0
                            THEN '<inputbuf>' || props || '</inputbuf>' ELSE '' END
                  || '</process></blocking-process>' ELSE '' END
               || '</blocked-process-report></TextData>' AS report
        FROM events""",
    "graphs": """
        SELECT doc_id, replace(replace(text, chr(10), '&#x0A;'), ' ', '&#x20;') AS graph
        FROM documents""",
    "backupset": f"""
        SELECT o_orderkey // 5 AS backup_set_id, {database_name("o_custkey")} AS database_name,
               'set_' || CAST(o_orderkey AS VARCHAR) AS name,
               CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'I' WHEN 'P' THEN 'L' END
                   AS type,
               CAST(o_orderkey * 1000 AS VARCHAR) AS first_lsn,
               CAST(o_orderkey * 1000 + 999 AS VARCHAR) AS last_lsn,
               o_orderdate AS backup_start_date,
               o_orderdate + to_seconds(o_orderkey % 7200) AS backup_finish_date,
               CAST(round(o_totalprice * 100) AS BIGINT) AS backup_size,
               CASE WHEN o_orderkey % 3 = 0 THEN 'FULL' ELSE 'SIMPLE' END AS recovery_model,
               o_orderkey % 50 = 0 AS is_damaged,
               {server("o_orderkey")} AS server_name
        FROM orders""",
    "backup_sets": f"""
        SELECT {server("event_id")} AS server, event_id // 5 AS set_id,
               event_id // 5 AS backup_set_id, {TRACKED_NAME} AS database,
               'set_' || CAST(event_id AS VARCHAR) AS name,
               CAST(NULL AS VARCHAR) AS first_lsn, CAST(NULL AS VARCHAR) AS last_lsn,
               CAST(NULL AS TIMESTAMP) AS backup_start_date,
               CAST(NULL AS TIMESTAMP) AS backup_finish_date,
               CAST(NULL AS BIGINT) AS size_kb, {letter(f"{K} % 3")} AS type,
               'set_' || CAST(event_id AS VARCHAR) || '.bak' AS file_name,
               'FULL' AS recovery_model, false AS is_damaged, {server("event_id")} AS machine,
               {BACKUP_TIME} AS create_datetime
        FROM events""",
    "backup_history": f"""
        SELECT {server("event_id")} AS server, event_id // 5 AS history_id,
               {HISTORY_SET} AS set_id, 'Backup_' || {database_name("user_id")} AS job_name,
               event_type = 'view' AS is_running, event_type = 'error' AS is_error,
               CASE WHEN event_type = 'error' THEN props END AS error_message,
               {BACKUP_TIME} AS process_start,
               CASE WHEN event_type = 'view' THEN {OPEN_END} ELSE {BACKUP_TIME} END
                   AS process_finish,
               {BACKUP_TIME} AS create_datetime
        FROM events""",
    "completions": f"""
        SELECT {server("event_id")} AS server, {HISTORY_SET} AS set_id,
               event_id // 3 AS backup_set_id,
               'done_' || CAST(event_id AS VARCHAR) || '.bak' AS file_name
        FROM events CROSS JOIN (VALUES (0), (1)) AS turns(turn)
        WHERE event_type = 'view' AND (turn = 0 OR event_id % 2 = 0)""",
    "failures": f"""
        SELECT {server("event_id")} AS server, {HISTORY_SET} AS set_id,
               'failed ' || props AS message
        FROM events CROSS JOIN (VALUES (0), (1)) AS turns(turn)
        WHERE event_type = 'view' AND {K} < 33 AND (turn = 0 OR event_id % 2 = 0)""",
    "tracked": f"""
        SELECT {server("event_id")} AS server, event_id // 5 AS set_id,
               {TRACKED_NAME} AS database, {letter(f"{K} % 3")} AS backup_type
        FROM events""",
    "candidates": """
        SELECT server, database_id, name, recovery_model FROM databases
        WHERE NOT is_read_only AND NOT is_in_standby AND database_id <> 2""",
    "latest_history": """
        SELECT h.server, s.database, h.history_id, h.process_finish, h.is_running
        FROM backup_history h JOIN backup_sets s ON h.server = s.server AND h.set_id = s.set_id
        QUALIFY row_number() OVER (PARTITION BY h.server, lower(s.database)
                                   ORDER BY h.history_id DESC) = 1""",
    "plan_rows": """
        SELECT c.server, c.database_id, c.name AS database, c.recovery_model,
               coalesce(l.is_running, false) AS is_running, hours.plan_hour,
               CASE WHEN coalesce(l.is_running, false) THEN NULL
                    WHEN l.process_finish IS NULL
                         OR CAST(l.process_finish AS DATE) <> DATE '2024-01-15' THEN 'D'
                    WHEN c.database_id > 4 AND hours.plan_hour IN (4, 8, 12, 16, 20) THEN 'I'
                    WHEN c.database_id > 4 AND c.recovery_model IN (1, 2) THEN 'L'
               END AS backup_type
        FROM candidates c
             LEFT JOIN latest_history l
                    ON l.server = c.server AND lower(l.database) = lower(c.name)
             CROSS JOIN (VALUES (13), (16)) AS hours(plan_hour)""",
    "names": """
        SELECT server, database_id, database, backup_type,
               CASE backup_type WHEN 'D' THEN 'Full Backup' WHEN 'I' THEN 'Differential Backup'
                    ELSE 'Transaction Log' END AS operation,
               'F:\\' || server || '\\' || database || '\\' || database
                    || CASE backup_type WHEN 'D' THEN '_Database_Full_'
                    WHEN 'I' THEN '_Database_Differential_' ELSE '_Transaction_Log_' END
                    || '20240115_13-30-00.00'
                    || CASE backup_type WHEN 'D' THEN '.bak' WHEN 'I' THEN '.dif' ELSE '.trn' END
                    AS file_name,
               'Backup_' || database || '_' || CASE backup_type WHEN 'D' THEN 'Full Backup'
                    WHEN 'I' THEN 'Differential Backup' ELSE 'Transaction Log' END
                    || '_[2024-01-15 13:30:00]' AS job_name
        FROM plan_rows WHERE plan_hour = 13 AND backup_type IS NOT NULL""",
    "instances": f"""
        SELECT 'id-' || CAST(c_custkey AS VARCHAR) AS server_instance_id,
               upper(n_name) AS server_name,
               CASE WHEN c_custkey % 3 = 1 THEN c_name ELSE upper(c_name) END AS instance_name,
               'F:\\Backup\\' || c_name AS backup_location,
               c_custkey % 4 = 0 AS primary_console, c_custkey % 10 <> 3 AS is_monitored,
               CASE WHEN c_acctbal >= 4500 THEN {OPEN_END} ELSE {DAY_START} END AS installed,
               strftime(DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER), '%Y-%m-%d')
                   AS create_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "offered_instances": """
        SELECT CASE copy WHEN 0 THEN '  ' || lower(n_name) || ' ' ELSE n_name END AS server_name,
               CASE copy WHEN 0 THEN lower(name) || '  ' ELSE name END AS instance_name,
               'G:\\Backup' || CAST(copy AS VARCHAR) AS backup_location
        FROM (SELECT *, CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN c_name
                             ELSE c_name || '_new' END AS name FROM customer) AS c
             JOIN nation ON c_nationkey = n_nationkey
             CROSS JOIN (VALUES (0), (1)) AS copies(copy)
        WHERE copy = 0 OR c_acctbal < 0""",
    "releases": f"""
        SELECT p_partkey + 1000 AS release_id, '1.0' AS version_number,
               CASE WHEN p_type IN ('STANDARD', 'ECONOMY', 'SMALL') THEN {brand_key("script_")}
                    ELSE {brand_key("past_")} END AS script_name, p_brand AS author,
               p_name AS object_name, p_type AS description, 'New' AS option,
               p_size % 5 = 0 AS is_error,
               CASE WHEN p_size % 5 = 0 THEN 'step ' || p_name END AS error_message,
               '2013-10-01' AS release_date, TIMESTAMP '2024-01-01 00:00:00' AS installed,
               TIMESTAMP '2024-01-01 00:00:00' AS updated
        FROM part""",
    "offered_releases": f"""
        SELECT p_partkey * 2 + copy AS seq,
               CASE WHEN p_size % 7 <> 0 THEN '2.0' END AS version_number,
               CASE WHEN p_partkey % 3 = copy THEN upper({brand_key("script_")})
                    ELSE {brand_key("script_")} END AS script_name, p_brand AS author,
               p_name AS object_name, p_type AS description,
               CASE copy WHEN 0 THEN 'New' ELSE 'Alter' END AS option,
               p_size % 4 = 0 AS is_error,
               CASE WHEN p_size % 4 = 0 THEN 'failed|at|' || p_name ELSE '' END AS error_message,
               '2024-01-10' AS release_date
        FROM part CROSS JOIN (VALUES (0), (1)) AS copies(copy)
        WHERE copy = 0 OR p_size <= 4""",
    "config": """
        SELECT c_custkey AS doc_id, 'HOST' || CAST(c_nationkey AS VARCHAR) AS "Server",
               c_name, c_mktsegment
        FROM customer""",
    "secondary": """
        SELECT doc_id, "Server", c_name || '_B' AS "Instance" FROM config
        UNION ALL
        SELECT doc_id, "Server",
               CASE WHEN doc_id % 3 = 0 THEN c_name ELSE c_name || '_C' END FROM config""",
    "catalog_columns": f"""
        SELECT {SCHEMA_NAME} AS schema_name, p_brand AS table_name, {brand_key("col_")} AS column_name, p_partkey AS ordinal,
               lower(p_type) AS data_type, CASE WHEN p_size % 10 = 0 THEN 'small' END
                   AS domain_name,
               CASE WHEN p_size % 13 = 0 THEN -1 ELSE p_size END AS max_length,
               p_size % 2 = 0 AS is_nullable,
               CASE WHEN p_size >= 44 THEN '(''d' || CAST(p_size AS VARCHAR) || ''')' END
                   AS default_value, p_partkey, p_size
        FROM part""",
    "profile": """
        SELECT c.schema_name, c.table_name, c.column_name, c.ordinal, c.data_type, c.domain_name,
               c.max_length, c.is_nullable, c.default_value,
               CASE WHEN p_size >= 44 AND p_size % 2 <> 0
                    THEN 'df_' || CAST(p_partkey AS VARCHAR) END AS default_name,
               p_size = 50 AS is_identity,
               CASE WHEN p_size = 50 THEN 1000 ELSE 0 END AS identity_seed,
               CASE WHEN p_size = 50 THEN 1 ELSE 0 END AS identity_increment,
               t.collation IS NOT NULL AS is_char
        FROM catalog_columns c JOIN (
                 SELECT DISTINCT lower(p_type) AS type_name,
                        CASE WHEN lower(p_type) IN ('small', 'medium', 'economy') THEN 'CI' END
                            AS collation
                 FROM part WHERE p_type <> 'PROMO') AS t
             ON t.type_name = coalesce(c.domain_name, c.data_type)""",
    "catalog_keys": f"""
        SELECT {SCHEMA_NAME} AS schema_name, p_brand AS table_name,
               CASE p_partkey // 16 % 4 WHEN 0 THEN 'pk_' WHEN 1 THEN 'uq_' WHEN 2 THEN 'fk_'
                    ELSE 'ix_' END || CAST(p_partkey // 16 AS VARCHAR) AS key_name,
               CASE p_partkey // 16 % 4 WHEN 0 THEN 'PK' WHEN 1 THEN 'UQ' WHEN 2 THEN 'FK'
                    ELSE 'IX' END AS kind,
               p_partkey % 32 < 16 AS is_clustered,
               CASE WHEN p_partkey // 16 % 4 = 2
                    THEN 'ref_' || CAST(p_partkey // 16 AS VARCHAR) END AS referenced_table,
               {brand_key("col_")} AS column_name,
               {brand_key("ref_col_")} AS referenced_column, p_partkey % 16 AS key_ordinal,
               p_size % 2 = 1 AS is_descending
        FROM part""",
    "key_columns": """
        SELECT schema_name, table_name, key_name, kind, is_clustered, referenced_table,
               count(*) AS n_columns,
               string_agg(column_name || CASE WHEN is_descending THEN ' DESC' ELSE ' ASC' END,
                          ',' ORDER BY key_ordinal) AS key_columns,
               string_agg(column_name, ',' ORDER BY key_ordinal) AS plain_columns,
               string_agg(referenced_column, ',' ORDER BY key_ordinal) AS referenced_columns
        FROM catalog_keys
        GROUP BY schema_name, table_name, key_name, kind, is_clustered, referenced_table""",
}


def with_fixtures(select: str) -> str:
    """``select`` behind the fixtures it names, directly or through others."""
    def named_in(sql: str) -> list[str]:
        words = set(re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", sql))
        return [name for name in FIXTURES if name in words]

    needed: list[str] = []

    def add(sql: str) -> None:
        for name in named_in(sql):
            if name not in needed:
                add(FIXTURES[name])
                needed.append(name)

    add(select)
    if not needed:
        return select
    ctes = ",\n".join(f"{name} AS ({FIXTURES[name]})" for name in needed)
    return f"WITH {ctes}\n{select}"
