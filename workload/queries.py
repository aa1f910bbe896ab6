"""The registered queries: every operator over the whole derived inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions import clock, codes
from fleetscope.operators import (
    audits, backups, catalog, incidents, job_activity, job_failures, keys, registry, services,
)
from fleetscope.plans import activity_poll, backup_cycle, failure_poll, fleet_status
from fleetscope.session import cut_lineage, fresh_folder
from fleetscope.sinks import snapshots
from fleetscope.sources import config_xml, fleet, listings, templates
from fleetscope.streaming import feeds
from workload import fixtures as fx
from workload.portable import NULLABLE_VALUES

QUERIES = {}


def query(function):
    """Register a query under its name."""
    name = function.__name__

    def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = {c: F.col(c).cast("string") for c in NULLABLE_VALUES.get(name, ())}
        result = function(spark, sf_dir)
        return result.withColumns(texts) if texts else result

    QUERIES[name] = registered
    return function


def _text(name: str) -> Column:
    """A timestamp or date as text, for values outside the range of other tools."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def _portable(df: DataFrame, *names: str) -> DataFrame:
    """Dates, decimals and given timestamps as text; other columns as they are."""

    def column(field) -> Column:
        kind = field.dataType.simpleString()
        if field.name in names:
            return _text(field.name)
        if kind == "date" or kind.startswith("decimal"):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


# --- Sources ---------------------------------------------------------------------


@query
def config_nodes_shred(spark: SparkSession, d: str) -> DataFrame:
    return config_xml.shred_elements(
        fx.config_docs(spark, d),
        "Instances/Secondaries/Database",
        ["Server", "Instance", "Backuplocation"],
    )


@query
def config_settings_pivot(spark: SparkSession, d: str) -> DataFrame:
    names = {"profile": "string", "address": "string", "port": "int", "ssl": "int"}
    return config_xml.pivot_settings(fx.config_docs(spark, d), "Mail/Settings/Setting", names)


@query
def template_text_render(spark: SparkSession, d: str) -> DataFrame:
    placeholders = {
        "<config_file>": "conf.xml",
        "<database>": "console",
        "<object>": "Collector.Events",
    }
    rendered = templates.render(F.col("template"), placeholders)
    return fx.templates(spark, d).select("doc_id", rendered.alias("script"))


@query
def fleet_union_collect(spark: SparkSession, d: str) -> DataFrame:
    """Three servers, each holding its own ten days of history."""
    first, second = fx.dt.datetime(2024, 1, 11), fx.dt.datetime(2024, 1, 21)
    return fleet.collect_fleet(
        {
            "EAST": fx.job_history(spark, d, before=first),
            "NORTH": fx.job_history(spark, d, since=first, before=second),
            "WEST": fx.job_history(spark, d, since=second),
        }
    )


@query
def command_output_parse(spark: SparkSession, d: str) -> DataFrame:
    return listings.parse_listing(fx.service_lines(spark, d))


# --- Sinks and keys ----------------------------------------------------------------


def _view(spark: SparkSession, d: str) -> DataFrame:
    return job_failures.failed_jobs_view(
        fx.day_history(spark, d), fx.jobs(spark, d), fx.job_steps(spark, d), fx.RUN_DAY
    )


def _recorded(spark: SparkSession, d: str) -> DataFrame:
    seen = _view(spark, d).filter(F.col("sql_severity") < 8)
    return seen.withColumn("create_datetime", clock.ntz(fx.DAY_START))


def _new(spark: SparkSession, d: str) -> DataFrame:
    return job_failures.failed_jobs_new(_view(spark, d), _recorded(spark, d))


@query
def failed_jobs_new_sketched(spark: SparkSession, d: str) -> DataFrame:
    """As failed_jobs_new, over a stored view whose keys thin the record first."""
    view = cut_lineage(_view(spark, d))
    return job_failures.failed_jobs_new(view, _recorded(spark, d), expected=view.count())


@query
def failed_jobs_append(spark: SparkSession, d: str) -> DataFrame:
    return job_failures.failed_jobs_append(_new(spark, d), _recorded(spark, d), fx.AS_OF)


@query
def blocked_events_store(spark: SparkSession, d: str) -> DataFrame:
    return incidents.blocked_events_store(fx.blocked_reports(spark, d))


@query
def deadlock_events_store(spark: SparkSession, d: str) -> DataFrame:
    return incidents.deadlock_events_store(fx.deadlock_docs(spark, d), fx.AS_OF)


@query
def surrogate_key_assign(spark: SparkSession, d: str) -> DataFrame:
    """Rows from the run day on get keys after those of the rows before it."""
    existing = fx.events(spark, d, before=fx.DAY_START).select(
        (F.col("event_id") + 1000).alias("row_key")
    )
    new = fx.events(spark, d, since=fx.DAY_START).select("event_id", "user_id", "event_type")
    return keys.assign_keys(new, "event_id", "row_key", existing, first=1000)


# --- Projections, filters, predicates --------------------------------------------------


@query
def instance_monitored(spark: SparkSession, d: str) -> DataFrame:
    return registry.instance_monitored(fx.instances(spark, d))


@query
def instance_pending_install(spark: SparkSession, d: str) -> DataFrame:
    return registry.instance_pending_install(fx.instances(spark, d))


@query
def backup_candidates(spark: SparkSession, d: str) -> DataFrame:
    return backups.backup_candidates(fx.databases(spark, d))


@query
def status_code_map(spark: SparkSession, d: str) -> DataFrame:
    """All six code sets over the history; the other codes come from its columns."""
    status = F.col("run_status")
    state = F.col("sql_severity") % 9
    letter = F.substring(F.lit("DILX"), 1, 4)
    letter = F.substr(letter, (F.col("step_id") + 1).cast("int"), F.lit(1))
    return fx.job_history(spark, d).select(
        "instance_id",
        codes.history_label(status).alias("history_label"),
        codes.uniform_code(F.when(F.col("step_id") != 0, status)).alias("uniform_code"),
        codes.uniform_label(F.when(F.col("step_id") != 0, status)).alias("uniform_label"),
        codes.running_code(state).alias("running_code"),
        codes.running_label(state).alias("running_label"),
        codes.outcome_label(status).alias("outcome_label"),
        codes.backup_type_label(letter).alias("backup_label"),
    )


@query
def stopped_services(spark: SparkSession, d: str) -> DataFrame:
    return services.stopped_services(listings.parse_listing(fx.service_lines(spark, d)))


@query
def null_default_project(spark: SparkSession, d: str) -> DataFrame:
    """Process attributes with the stated default where they are absent."""
    rows = incidents.process_rows(fx.blocked_reports(spark, d))
    defaulted = F.coalesce(F.col("database_id"), F.lit(-1)).alias("database_id")
    names = [c for c in incidents.DETAIL_COLUMNS if c != "currentdb"]
    return rows.select("event_id", "position", defaulted, *names)


# --- Joins -------------------------------------------------------------------------


@query
def failed_jobs_view(spark: SparkSession, d: str) -> DataFrame:
    return _view(spark, d)


@query
def backup_view(spark: SparkSession, d: str) -> DataFrame:
    view = backups.backup_view(fx.backup_history(spark, d), fx.backup_sets(spark, d))
    return _portable(
        view, "backup_start_date", "backup_finish_date", "process_start", "process_finish",
        "create_datetime",
    )


def _past(spark: SparkSession, d: str) -> DataFrame:
    return fx.job_history(spark, d, until=fx.AS_OF)


@query
def job_step_outer(spark: SparkSession, d: str) -> DataFrame:
    rows = job_activity.job_step_outer(
        fx.job_steps(spark, d), _past(spark, d), fx.job_activity(spark, d)
    )
    return _portable(rows, "step_start")


@query
def failed_jobs_new(spark: SparkSession, d: str) -> DataFrame:
    return _new(spark, d)


@query
def release_pending(spark: SparkSession, d: str) -> DataFrame:
    offered = fx.offered_releases(spark, d).select(
        F.col("seq").alias("list_id"), "script_name", "object_name"
    )
    return registry.release_pending(offered, fx.releases(spark, d))


@query
def existence_semi_join(spark: SparkSession, d: str) -> DataFrame:
    return registry.existence_semi_join(
        fx.mail_profiles(spark, d), fx.mail_links(spark, d), fx.mail_accounts(spark, d)
    )


@query
def database_name_lookup(spark: SparkSession, d: str) -> DataFrame:
    listed = incidents.process_list(fx.blocked_reports(spark, d)).select("event_id", "server", "processes")
    named = incidents.database_name_lookup(listed, fx.databases(spark, d))
    return incidents.process_rows(named).select("event_id", "position", "database_id", "currentdb")


@query
def lateral_derive(spark: SparkSession, d: str) -> DataFrame:
    return listings.derive_levels(fx.service_lines(spark, d))


def _profile(spark: SparkSession, d: str) -> DataFrame:
    return catalog.catalog_column_profile(
        fx.catalog_columns(spark, d),
        fx.catalog_identity(spark, d),
        fx.catalog_types(spark, d),
        fx.catalog_defaults(spark, d),
    )


@query
def catalog_column_profile(spark: SparkSession, d: str) -> DataFrame:
    return _profile(spark, d)


# --- Aggregation -------------------------------------------------------------------


@query
def recipients_concat(spark: SparkSession, d: str) -> DataFrame:
    return registry.recipients_concat(fx.alert_emails(spark, d), ["team"])


@query
def backup_latest_set(spark: SparkSession, d: str) -> DataFrame:
    return backups.backup_latest_set(fx.backupset(spark, d))


@query
def backup_verify_missing(spark: SparkSession, d: str) -> DataFrame:
    tracked = fx.backup_tracked(spark, d)
    return backups.backup_verify_missing(tracked, fx.backupset(spark, d))


@query
def backup_latest_history(spark: SparkSession, d: str) -> DataFrame:
    latest = backups.backup_latest_history(fx.backup_history(spark, d), fx.backup_sets(spark, d))
    return _portable(latest, "process_finish")


@query
def catalog_key_columns(spark: SparkSession, d: str) -> DataFrame:
    return catalog.catalog_key_columns(fx.catalog_keys(spark, d))


@query
def new_row_guard(spark: SparkSession, d: str) -> DataFrame:
    return job_failures.new_row_guard(_new(spark, d))


# --- Top-k, ordering, set operations ------------------------------------------------


@query
def latest_activity_per_job(spark: SparkSession, d: str) -> DataFrame:
    rows = job_activity.latest_activity_per_job(
        fx.jobs(spark, d), fx.job_activity(spark, d), fx.AS_OF
    )
    return _portable(rows, "job_start")


@query
def latest_activity_polled(spark: SparkSession, d: str) -> DataFrame:
    """As latest_activity_per_job, from three polls, of which the last is late and overlaps both others."""
    location, activity = fresh_folder(spark, "newest-runs"), fx.job_activity(spark, d)
    middle, late = clock.ntz(fx.dt.datetime(2024, 1, 8)), clock.ntz(fx.dt.datetime(2024, 1, 11))
    for polled in (F.col("start") < middle, F.col("start") >= late, F.lit(True)):
        activity_poll.merge_activity(activity.filter(polled), location)
    return _portable(activity_poll.latest_activity_per_job(fx.jobs(spark, d), location, fx.AS_OF), "job_start")


@query
def current_jobs_status(spark: SparkSession, d: str) -> DataFrame:
    rows = job_activity.current_jobs_status(
        fx.job_listing(spark, d),
        fx.jobs(spark, d),
        fx.job_servers(spark, d),
        fx.job_activity(spark, d),
        fx.AS_OF,
    )
    return _portable(rows, "job_start").orderBy(F.desc("is_enabled"), "job_name")


@query
def current_job_steps(spark: SparkSession, d: str) -> DataFrame:
    rows = job_activity.current_job_steps(
        fx.job_listing(spark, d),
        fx.jobs(spark, d),
        fx.job_steps(spark, d),
        _past(spark, d),
        fx.job_activity(spark, d),
    )
    return _portable(rows, "step_start")


@query
def current_jobs_all(spark: SparkSession, d: str) -> DataFrame:
    rows = fleet_status.fleet_status(
        fx.job_listing(spark, d),
        fx.jobs(spark, d),
        fx.job_servers(spark, d),
        fx.job_steps(spark, d),
        _past(spark, d),
        fx.job_activity(spark, d),
        fx.AS_OF,
    )
    return _portable(rows, "started")


@query
def instance_topology_union(spark: SparkSession, d: str) -> DataFrame:
    return config_xml.instance_topology(
        fx.config_docs(spark, d),
        "Instances/Primary",
        "Instances/Secondaries/Database",
        ["Server", "Instance", "Backuplocation"],
    )


# --- State changes -----------------------------------------------------------------


@query
def release_upsert(spark: SparkSession, d: str) -> DataFrame:
    return _portable(
        registry.release_upsert(
            fx.releases(spark, d), fx.offered_releases(spark, d), fx.AS_OF
        )
    )


@query
def instance_register(spark: SparkSession, d: str) -> DataFrame:
    known = fx.instances(spark, d)
    registered = registry.instance_register(known, fx.offered_instances(spark, d), fx.AS_OF)
    return _portable(registered.drop("server_instance_id"), "installed")


@query
def instance_primary_flag(spark: SparkSession, d: str) -> DataFrame:
    flagged = registry.instance_primary_flag(
        fx.instances(spark, d), "NATION_19\\CUSTOMER#000000001", fx.AS_OF
    )
    return _portable(flagged, "installed")


def _names(spark: SparkSession, d: str) -> DataFrame:
    plan = backups.backup_plan(
        fx.databases(spark, d), fx.backup_history(spark, d), fx.backup_sets(spark, d), fx.AS_OF
    )
    return backups.backup_names(plan, fx.AS_OF, location=fx.backup_location())


def _tracking(spark: SparkSession, d: str) -> tuple[str, snapshots.Snapshot]:
    """Both tracking tables, stored."""
    location = fresh_folder(spark, "tracking")
    stored = {backup_cycle.SETS: fx.backup_sets(spark, d), backup_cycle.HISTORY: fx.backup_history(spark, d)}
    return location, snapshots.commit(spark, snapshots.Snapshot(location), backup_cycle.CREATED, stored)


@query
def backup_start(spark: SparkSession, d: str) -> DataFrame:
    """The rows that a decision stored in both tables, joined on the key they share."""
    location, before = _tracking(spark, d)
    state, _ = backup_cycle.run_decision(spark, location, fx.databases(spark, d), fx.AS_OF)
    added = {t: [p for p in parts if p not in before.of(t)] for t, parts in state.parts.items()}
    new_sets, new_history = (
        snapshots.open_parts(spark, state, t, added[t]) for t in (backup_cycle.SETS, backup_cycle.HISTORY)
    )
    both = new_sets.select("server", "set_id", "backup_set_id", "database").join(
        new_history.drop("server"), "set_id"
    )
    return _portable(both, "process_start", "process_finish", "create_datetime")


def _both_tables(sets: DataFrame, history: DataFrame) -> DataFrame:
    both = history.select(
        *backups.SET, "history_id", "is_running", "is_error", "error_message", "process_finish"
    ).join(sets, backups.SET, "left")
    return _portable(
        both, "process_finish", "backup_start_date", "backup_finish_date", "create_datetime"
    )


@query
def backup_complete(spark: SparkSession, d: str) -> DataFrame:
    return _both_tables(
        *backups.backup_complete(
            fx.backup_sets(spark, d),
            fx.backup_history(spark, d),
            fx.backup_completions(spark, d),
            fx.backupset(spark, d),
            fx.AS_OF,
        )
    )


@query
def backup_fail(spark: SparkSession, d: str) -> DataFrame:
    failed = backups.backup_fail(
        fx.backup_history(spark, d), fx.backup_failures(spark, d), fx.AS_OF
    )
    return _portable(failed, "process_start", "process_finish", "create_datetime")


@query
def backup_retention(spark: SparkSession, d: str) -> DataFrame:
    """What both stored tables keep after the daily run; a reset keeps nothing."""
    location, _ = _tracking(spark, d)
    daily = backup_cycle.run_retention(spark, location, fx.AS_OF)
    empty = backup_cycle.run_retention(spark, location, fx.AS_OF, backups.RESET)
    kept = [
        snapshots.open_parts(spark, state, table).select(
            F.lit(name).alias("table_name"), "server", F.col(key).alias("row_id"), "create_datetime"
        )
        for name, key, table, state in (
            ("history", "history_id", backup_cycle.HISTORY, daily),
            ("sets", "set_id", backup_cycle.SETS, daily),
            ("reset", "set_id", backup_cycle.SETS, empty),
        )
    ]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


# --- Decisions and rendering ----------------------------------------------------------


@query
def backup_plan(spark: SparkSession, d: str) -> DataFrame:
    """The plan at an hour without and at an hour with differential backups."""
    plans = [
        backups.backup_plan(
            fx.databases(spark, d), fx.backup_history(spark, d), fx.backup_sets(spark, d), now
        ).withColumn("plan_hour", F.lit(now.hour))
        for now in (fx.AS_OF, fx.AS_OF_DIFF)
    ]
    return plans[0].unionByName(plans[1])


@query
def backup_names(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d)


@query
def failed_jobs_report(spark: SparkSession, d: str) -> DataFrame:
    return job_failures.failed_jobs_report(cut_lineage(_new(spark, d)), fx.AS_OF)


@query
def stopped_services_report(spark: SparkSession, d: str) -> DataFrame:
    stopped = services.stopped_services(listings.parse_listing(fx.service_lines(spark, d)))
    return services.stopped_services_report(stopped, fx.AS_OF)


@query
def blocked_process_details(spark: SparkSession, d: str) -> DataFrame:
    return incidents.blocked_process_details(
        fx.blocked_reports(spark, d), fx.databases(spark, d)
    )


@query
def blocked_report_render(spark: SparkSession, d: str) -> DataFrame:
    return incidents.blocked_report_render(fx.blocked_reports(spark, d), fx.databases(spark, d))


@query
def deadlock_text_normalise(spark: SparkSession, d: str) -> DataFrame:
    return incidents.deadlock_text_normalise(fx.deadlock_docs(spark, d))


@query
def catalog_table_script(spark: SparkSession, d: str) -> DataFrame:
    return catalog.catalog_table_script(
        cut_lineage(_profile(spark, d)),
        catalog.catalog_key_columns(fx.catalog_keys(spark, d)),
        fx.catalog_checks(spark, d),
        database="console",
    )


# --- Audits -------------------------------------------------------------------------


@query
def placement_violations(spark: SparkSession, d: str) -> DataFrame:
    return audits.placement_violations(
        fx.catalog_indexes(spark, d), fx.data_spaces(spark, d), "Configuration", "Configure"
    )


@query
def key_constraint_audit(spark: SparkSession, d: str) -> DataFrame:
    offered = fx.offered_instances(spark, d).select(
        F.upper(F.trim("server_name")).alias("server_name"),
        F.nullif(F.upper(F.trim("instance_name")), F.lit("CUSTOMER#000000003")).alias(
            "instance_name"
        ),
    )
    return audits.key_constraint_audit(offered, ["server_name", "instance_name"])


@query
def foreign_key_audit(spark: SparkSession, d: str) -> DataFrame:
    orphans = audits.foreign_key_audit(
        fx.backup_history(spark, d), fx.backup_sets(spark, d), backups.SET
    )
    return orphans.select("server", "history_id", "set_id", "job_name", "is_running", "is_error")


# --- Streams ------------------------------------------------------------------------


@query
def stream_failed_jobs(spark: SparkSession, d: str) -> DataFrame:
    """The record after polling the event feed, part of it recorded before."""
    location = fresh_folder(spark, "failed-jobs")
    feed = fx.feed(spark, d, "events")
    seen = _recorded(spark, d).drop("create_datetime")
    failure_poll.record_failures(seen, location, fx.DAY_START)
    feeds.record_failed_jobs(
        fx.history_of(feed),
        fx.jobs(spark, d),
        fx.job_steps(spark, d),
        location,
        fresh_folder(spark, "failed-jobs-state"),
        fx.AS_OF,
    )
    return failure_poll.recorded_failures(spark, location)


@query
def stream_blocked_events(spark: SparkSession, d: str) -> DataFrame:
    """The stored details with the id and session id of their event."""
    events_at, details_at = fresh_folder(spark, "blocked"), fresh_folder(spark, "details")
    feed = fx.feed(spark, d, "events")
    feeds.record_blocked_events(
        fx.reports_of(feed),
        fx.databases(spark, d),
        events_at,
        details_at,
        fresh_folder(spark, "blocked-state"),
    )
    stored = spark.read.parquet(events_at).drop(feeds.BATCH)
    return stored.join(spark.read.parquet(details_at).drop(feeds.BATCH), "event_id")


@query
def stream_deadlock_events(spark: SparkSession, d: str) -> DataFrame:
    """The stored graphs joined to their normalised text."""
    events_at, texts_at = fresh_folder(spark, "deadlocks"), fresh_folder(spark, "texts")
    feed = fx.feed(spark, d, "documents")
    feeds.record_deadlock_events(
        fx.graphs_of(feed), events_at, texts_at, fresh_folder(spark, "deadlock-state"), fx.AS_OF
    )
    stored = spark.read.parquet(events_at).drop(feeds.BATCH)
    return stored.join(spark.read.parquet(texts_at).drop(feeds.BATCH), "doc_id")


# --- Decoders ------------------------------------------------------------------------


@query
def agent_datetime_decode(spark: SparkSession, d: str) -> DataFrame:
    """The decoded time; every hundredth date is 0, which means never."""
    date = F.when(F.col("instance_id") % 100 == 0, 0).otherwise(F.col("run_date"))
    decoded = fx.job_history(spark, d).select(
        "instance_id",
        date.alias("run_date"),
        "run_time",
        clock.agent_datetime(date, F.col("run_time")).alias("exec_date"),
    )
    return _portable(decoded, "exec_date")


@query
def hhmmss_duration_decode(spark: SparkSession, d: str) -> DataFrame:
    duration = F.col("run_duration")
    return fx.job_history(spark, d).select(
        "instance_id",
        "run_duration",
        clock.wrapped_label(clock.hhmmss_seconds(duration % 240000)).alias("wrapped"),
        clock.hhmmss_seconds(duration).alias("seconds"),
    )
