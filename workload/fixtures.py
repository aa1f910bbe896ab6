"""Operational records derived from the given tables (see FIXTURES.md).

Each function reads the whole tables it needs and derives rows by a fixed rule
that plain SQL can repeat; ``fixture_sql`` holds the same rules as SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions import clock
from fleetscope.schemas import OPEN_END
from fleetscope.sinks.tables import is_folder
from fleetscope.streaming.feeds import file_feed

AS_OF = dt.datetime(2024, 1, 15, 13, 30)
AS_OF_DIFF = dt.datetime(2024, 1, 15, 16, 30)
RUN_DAY = dt.date(2024, 1, 15)
DAY_START = dt.datetime(2024, 1, 15)
DAY_END = dt.datetime(2024, 1, 16)
SERVERS = 5

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """
        c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """
        p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """
        o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """
        l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """
        event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read with its declared schema so no file is opened to plan."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of its files, be it one file or a folder of them."""
    location = f"{sf_dir}/{name}.parquet"
    if is_folder(spark, location):
        return file_feed(spark, location, SCHEMAS[name], "*.parquet")
    return file_feed(spark, sf_dir, SCHEMAS[name], f"{name}.parquet")


def events(
    spark: SparkSession,
    sf_dir: str,
    since: dt.datetime | None = None,
    before: dt.datetime | None = None,
    until: dt.datetime | None = None,
) -> DataFrame:
    """Events of a time range; the bounds are on ``ts`` so they reach the scan."""
    df = table(spark, sf_dir, "events")
    if since:
        df = df.filter(F.col("ts") >= clock.ntz(since))
    if before:
        df = df.filter(F.col("ts") < clock.ntz(before))
    if until:
        df = df.filter(F.col("ts") <= clock.ntz(until))
    return df


def _k() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def _database_name(key: str) -> Column:
    """One name on every server."""
    return F.concat(F.lit("Customer#"), F.lpad(_local(key).cast("string"), 9, "0"))


def _server(key: str) -> Column:
    """The server of a key; ``_local`` is its number there, so numbers repeat over servers."""
    return F.concat(F.lit("SRV"), (F.col(key) % SERVERS).cast("string"))


def _local(key: str) -> Column:
    return clock.int_div(F.col(key), SERVERS)


def _after(moment: str, seconds: Column) -> Column:
    return F.col(moment) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


# --- Job monitoring -----------------------------------------------------------


def history_of(source: DataFrame) -> DataFrame:
    """Job history rows of an events frame, batch or streaming."""
    ts = F.col("ts")
    return source.select(
        F.col("event_id").alias("instance_id"),
        _local("user_id").alias("job_id"),
        (_k() % 4).alias("step_id"),
        F.when(F.col("event_type") == "error", 0)
        .when(F.col("event_type") == "purchase", 1)
        .when(F.col("event_type") == "view", 2)
        .when(F.col("event_type") == "click", 3)
        .otherwise(4)
        .alias("run_status"),
        (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).alias("run_date"),
        (F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)).alias("run_time"),
        clock.seconds_hhmmss(F.floor(F.col("value") * 1000)).cast("int").alias("run_duration"),
        (_k() * 100).alias("sql_message_id"),
        (_k() % 25).alias("sql_severity"),
        F.col("props").alias("message"),
        _server("user_id").alias("server"),
    )


def job_history(spark: SparkSession, sf_dir: str, **bounds) -> DataFrame:
    return history_of(events(spark, sf_dir, **bounds))


def day_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_history(spark, sf_dir, since=DAY_START, before=DAY_END)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _local("c_custkey").alias("job_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("enabled"),
        _server("c_custkey").alias("server"),
    )


def job_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_mktsegment", step.alias("step_id"))
        .select(
            _local("c_custkey").alias("job_id"),
            "step_id",
            F.concat_ws("_", "c_mktsegment", F.col("step_id").cast("string")).alias("step_name"),
            _server("c_custkey").alias("server"),
        )
    )


def job_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir, until=AS_OF)
        .filter(F.col("event_type") == "signup")
        .select(
            _local("user_id").alias("job_id"),
            F.col("ts").alias("start"),
            F.when(F.col("event_id") % 5 != 0, _after("ts", F.floor("value"))).alias("stop"),
            _server("user_id").alias("server"),
        )
    )


def job_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _local("c_custkey").alias("job_id"),
        (key % 2).cast("int").alias("running"),
        (key % 4).cast("int").alias("current_step"),
        (key % 8).cast("int").alias("job_state"),
        _server("c_custkey").alias("server"),
    )


def job_servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = F.col("c_nationkey") % 4
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") != "FURNITURE")
        .select(
            _local("c_custkey").alias("job_id"),
            _server("c_custkey").alias("server"),
            F.when(pick == 0, 0)
            .when(pick == 1, 1)
            .when(pick == 2, 3)
            .otherwise(5)
            .alias("last_run_outcome"),
        )
    )


def service_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings per nation: three header lines, then one line per supplier."""
    server = F.col("n_nationkey").cast("string")
    headers = table(spark, sf_dir, "nation").select(
        server.alias("server"),
        F.posexplode(F.array(F.lit(""), F.lit("Name Status DisplayName"), F.lit("---- ------ ---"))),
    ).select("server", (F.col("pos") + 1).cast("long").alias("row_id"), F.col("col").alias("value"))
    number = F.col("s_suppkey").cast("string")
    name = F.concat(
        F.when(F.col("s_suppkey") % 3 == 0, "MSSQL$")
        .when(F.col("s_suppkey") % 3 == 1, "SQLAGENT$")
        .otherwise("SQLWriter"),
        number,
    )
    line = F.concat(
        name,
        F.lit("  "),
        F.when(F.col("s_suppkey") % 2 == 0, "Running").otherwise("Stopped"),
        F.lit("  SQL Server ("),
        F.when(F.col("s_suppkey") % 7 == 0, F.lower(name)).otherwise(name),
        F.lit(")"),
    )
    value = (
        F.when(F.col("s_suppkey") % 29 == 0, F.lit(None).cast("string"))
        .when(F.col("s_suppkey") % 31 == 0, name)
        .otherwise(line)
    )
    lines = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("server"),
        (F.col("s_suppkey") + 4).alias("row_id"),
        value.alias("value"),
    )
    return headers.unionByName(lines)


# --- Events ---------------------------------------------------------------------


def _xml_attribute(name: str, value: Column) -> Column:
    text = value.cast("string")
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return F.coalesce(F.concat(F.lit(f' {name}="'), text, F.lit('"')), F.lit(""))


def reports_of(source: DataFrame) -> DataFrame:
    """Blocked process reports of an events frame, batch or streaming."""
    event = F.col("event_id")

    def unless(divisor: int, value: Column) -> Column:
        return F.when(event % divisor != 0, value)

    host = F.concat(F.lit("HOST"), (event % 10).cast("string"))
    login = F.concat(F.lit("user<"), F.col("user_id").cast("string"), F.lit(">"))
    inputbuf = F.concat(F.lit("<inputbuf>"), F.col("props"), F.lit("</inputbuf>"))
    blocked = F.concat(
        F.lit("<blocked-process><process"),
        _xml_attribute("waittime", F.floor(F.col("value") * 1000)),
        _xml_attribute("transactionname", unless(5, F.lit("user_transaction"))),
        _xml_attribute("lockMode", unless(2, F.lit("X"))),
        _xml_attribute("status", F.col("event_type")),
        _xml_attribute("clientapp", F.lit("app & co")),
        _xml_attribute("hostname", unless(3, host)),
        _xml_attribute("loginname", login),
        _xml_attribute("currentdb", _local("user_id")),
        F.lit(">"),
        inputbuf,
        F.lit("</process></blocked-process>"),
    )
    blocking = F.concat(
        F.lit("<blocking-process><process"),
        _xml_attribute("spid", F.col("user_id")),
        _xml_attribute("status", F.lit("running")),
        _xml_attribute("hostname", host),
        _xml_attribute("loginname", unless(11, login)),
        _xml_attribute("currentdb", _local("user_id") + 1),
        F.lit(">"),
        F.when(event % 4 != 0, inputbuf).otherwise(F.lit("")),
        F.lit("</process></blocking-process>"),
    )
    return source.select(
        "event_id",
        F.col("ts").alias("alert"),
        F.concat(
            F.lit("<TextData><blocked-process-report>"),
            blocked,
            F.when(event % 7 != 0, blocking).otherwise(F.lit("")),
            F.lit("</blocked-process-report></TextData>"),
        ).alias("report"),
        _server("user_id").alias("server"),
    )


def blocked_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports_of(events(spark, sf_dir))


def graphs_of(source: DataFrame) -> DataFrame:
    """Deadlock graphs of a documents frame, batch or streaming."""
    graph = F.replace(F.col("text"), F.lit("\n"), F.lit("&#x0A;"))
    return source.select("doc_id", F.replace(graph, F.lit(" "), F.lit("&#x20;")).alias("graph"))


def deadlock_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs_of(table(spark, sf_dir, "documents"))


# --- Backups --------------------------------------------------------------------


def databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        (_local("c_custkey") + 1).alias("database_id"),
        _database_name("c_custkey").alias("name"),
        (F.col("c_custkey") % 3 + 1).cast("int").alias("recovery_model"),
        (F.col("c_mktsegment") == "MACHINERY").alias("is_read_only"),
        (F.col("c_nationkey") == 0).alias("is_in_standby"),
        _server("c_custkey").alias("server"),
    )


def _letter(value: Column) -> Column:
    return F.when(value == 0, "D").when(value == 1, "I").otherwise("L")


def backupset(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    letter = (
        F.when(F.col("o_orderstatus") == "F", "D")
        .when(F.col("o_orderstatus") == "O", "I")
        .when(F.col("o_orderstatus") == "P", "L")
    )
    return table(spark, sf_dir, "orders").select(
        _local("o_orderkey").alias("backup_set_id"),
        _database_name("o_custkey").alias("database_name"),
        F.concat(F.lit("set_"), key.cast("string")).alias("name"),
        letter.alias("type"),
        (key * 1000).cast("decimal(25,0)").alias("first_lsn"),
        (key * 1000 + 999).cast("decimal(25,0)").alias("last_lsn"),
        F.col("o_orderdate").alias("backup_start_date"),
        _after("o_orderdate", key % 7200).alias("backup_finish_date"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("backup_size"),
        F.when(key % 3 == 0, "FULL").otherwise("SIMPLE").alias("recovery_model"),
        (key % 50 == 0).alias("is_damaged"),
        _server("o_orderkey").alias("server_name"),
    )


def backup_location() -> Column:
    """The backup folder of a server."""
    return F.concat(F.lit("F:\\"), F.col("server"), F.lit("\\"))


def _backup_time() -> Column:
    """The time of an event, moved so that the last one lies before ``AS_OF``."""
    return F.col("ts") - F.make_dt_interval(F.lit(15), F.lit(10), F.lit(30))


def _tracked_name() -> Column:
    """The database of an event, every third time in another case."""
    name = _database_name("user_id")
    return F.when(F.col("event_id") % 3 == 0, F.upper(name)).otherwise(name)


def _history_set() -> Column:
    """The set that an event's history names; one in a hundred has none."""
    return F.when(_k() == 13, -_local("event_id") - 1).otherwise(_local("event_id"))


def _twice(df: DataFrame) -> DataFrame:
    """Every other row repeated, as servers that report again do."""
    turns = F.when(F.col("event_id") % 2 == 0, 2).otherwise(1)
    return df.withColumn("_turn", F.explode(F.sequence(F.lit(1), turns))).drop("_turn")


def backup_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("event_id").cast("string")
    none = F.lit(None)
    return events(spark, sf_dir).select(
        _local("event_id").alias("set_id"),
        _local("event_id").alias("backup_set_id"),
        _tracked_name().alias("database"),
        F.concat(F.lit("set_"), text).alias("name"),
        none.cast("decimal(25,0)").alias("first_lsn"),
        none.cast("decimal(25,0)").alias("last_lsn"),
        none.cast("timestamp_ntz").alias("backup_start_date"),
        none.cast("timestamp_ntz").alias("backup_finish_date"),
        none.cast("long").alias("size_kb"),
        _letter(_k() % 3).alias("type"),
        F.concat(F.lit("set_"), text, F.lit(".bak")).alias("file_name"),
        F.lit("FULL").alias("recovery_model"),
        F.lit(False).alias("is_damaged"),
        _server("event_id").alias("machine"),
        _backup_time().alias("create_datetime"),
        _server("event_id").alias("server"),
    )


def backup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = F.col("event_type") == "view"
    failed = F.col("event_type") == "error"
    moment = _backup_time()
    return events(spark, sf_dir).select(
        _local("event_id").alias("history_id"),
        _history_set().alias("set_id"),
        F.concat(F.lit("Backup_"), _database_name("user_id")).alias("job_name"),
        running.alias("is_running"),
        failed.alias("is_error"),
        F.when(failed, F.col("props")).alias("error_message"),
        moment.alias("process_start"),
        F.when(running, clock.ntz(OPEN_END)).otherwise(moment).alias("process_finish"),
        moment.alias("create_datetime"),
        _server("event_id").alias("server"),
    )


def backup_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What servers report for running backups; some name an unknown set, some come twice."""
    event = F.col("event_id")
    return _twice(events(spark, sf_dir).filter(F.col("event_type") == "view")).select(
        _server("event_id").alias("server"),
        _history_set().alias("set_id"),
        clock.int_div(event, 3).alias("backup_set_id"),
        F.concat(F.lit("done_"), event.cast("string"), F.lit(".bak")).alias("file_name"),
    )


def backup_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked backups with the letter of the set they should have."""
    return events(spark, sf_dir).select(
        _server("event_id").alias("server"),
        _local("event_id").alias("set_id"),
        _tracked_name().alias("database"),
        _letter(_k() % 3).alias("backup_type"),
    )


def backup_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of running backups, some reported twice."""
    running = (F.col("event_type") == "view") & (_k() < 33)
    return _twice(events(spark, sf_dir).filter(running)).select(
        _server("event_id").alias("server"),
        _history_set().alias("set_id"),
        F.concat(F.lit("failed "), F.col("props")).alias("message"),
    )


# --- Registry, releases, recipients, configuration ---------------------------------


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("id-"), key.cast("string")).alias("server_instance_id"),
            F.upper("n_name").alias("server_name"),
            F.when(key % 3 == 1, F.col("c_name")).otherwise(F.upper("c_name")).alias("instance_name"),
            F.concat(F.lit("F:\\Backup\\"), F.col("c_name")).alias("backup_location"),
            (key % 4 == 0).alias("primary_console"),
            (key % 10 != 3).alias("is_monitored"),
            F.when(F.col("c_acctbal") >= 4500, clock.ntz(OPEN_END))
            .otherwise(clock.ntz(DAY_START))
            .alias("installed"),
            F.date_add(F.lit("2024-01-01").cast("date"), (key % 28).cast("int")).alias(
                "create_date"
            ),
        )
    )


def offered_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances to register: known ones in two segments, the rest new.

    Padded lower-case names, some offered twice.
    """
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    known = F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")
    name = F.when(known, F.col("c_name")).otherwise(F.concat("c_name", F.lit("_new")))
    rows = (
        table(spark, sf_dir, "customer")
        .withColumn("name", name)
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    copies = F.when(F.col("c_acctbal") < 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return (
        rows.withColumn("copy", F.explode(copies))
        .select(
            F.when(F.col("copy") == 0, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
            .otherwise(F.col("n_name"))
            .alias("server_name"),
            F.when(F.col("copy") == 0, F.concat(F.lower("name"), F.lit("  ")))
            .otherwise(F.col("name"))
            .alias("instance_name"),
            F.concat(F.lit("G:\\Backup"), F.col("copy").cast("string")).alias("backup_location"),
        )
    )


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    failed = F.col("p_size") % 5 == 0
    offered = F.col("p_type").isin("STANDARD", "ECONOMY", "SMALL")
    return (
        table(spark, sf_dir, "part")
        .select(
            (key + 1000).alias("release_id"),
            F.lit("1.0").cast("decimal(3,1)").alias("version_number"),
            F.concat(
                F.when(offered, "script_").otherwise("past_"), key.cast("string")
            ).alias("script_name"),
            F.col("p_brand").alias("author"),
            F.col("p_name").alias("object_name"),
            F.col("p_type").alias("description"),
            F.lit("New").alias("option"),
            failed.alias("is_error"),
            F.when(failed, F.concat(F.lit("step "), F.col("p_name"))).alias("error_message"),
            F.lit("2013-10-01").cast("date").alias("release_date"),
            clock.ntz(dt.datetime(2024, 1, 1)).alias("installed"),
            clock.ntz(dt.datetime(2024, 1, 1)).alias("updated"),
        )
    )


def offered_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Script runs to record, in ``seq`` order; some scripts ran twice, some in another case."""
    key = F.col("p_partkey")
    name = F.concat(F.lit("script_"), key.cast("string"))
    copies = F.when(F.col("p_size") <= 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        table(spark, sf_dir, "part")
        .withColumn("copy", F.explode(copies))
        .select(
            (key * 2 + F.col("copy")).alias("seq"),
            F.when(F.col("p_size") % 7 != 0, F.lit("2.0").cast("decimal(3,1)")).alias(
                "version_number"
            ),
            F.when(key % 3 == F.col("copy"), F.upper(name)).otherwise(name).alias("script_name"),
            F.col("p_brand").alias("author"),
            F.col("p_name").alias("object_name"),
            F.col("p_type").alias("description"),
            F.when(F.col("copy") == 0, "New").otherwise("Alter").alias("option"),
            (F.col("p_size") % 4 == 0).alias("is_error"),
            F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("failed|at|"), F.col("p_name")))
            .otherwise(F.lit(""))
            .alias("error_message"),
            F.lit("2024-01-10").cast("date").alias("release_date"),
        )
    )


def alert_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("email_id"),
        F.col("c_name").alias("name"),
        F.concat(F.col("c_name"), F.lit("@Example.com")).alias("address"),
        (F.col("c_acctbal") > 0).alias("is_active"),
        F.col("c_nationkey").alias("team"),
    )


def mail_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("profile_id"), F.col("o_orderpriority").alias("profile_name")
    )


def mail_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("profile_id"), F.col("l_suppkey").alias("account_id")
    )


def mail_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") > 8000)
        .select(F.col("s_suppkey").alias("account_id"), F.col("s_name").alias("account_name"))
    )


def config_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration document per customer.

    A primary instance, two secondary ones (the second repeats the primary for
    every third customer) and a settings list; the port is left out of every
    fifth document.
    """
    key = F.col("c_custkey")

    def element(tag: str, instance: Column) -> Column:
        return F.concat(
            F.lit(f"<{tag}"),
            _xml_attribute("Server", F.concat(F.lit("HOST"), F.col("c_nationkey").cast("string"))),
            _xml_attribute("Instance", instance),
            _xml_attribute("Backuplocation", F.concat(F.lit("F:\\"), instance)),
            F.lit("/>"),
        )

    def setting(name: str, value: Column) -> Column:
        return F.concat(
            F.lit("<Setting"),
            _xml_attribute("Name", F.lit(name)),
            _xml_attribute("Value", value),
            F.lit("/>"),
        )

    second = F.when(key % 3 == 0, F.col("c_name")).otherwise(
        F.concat(F.col("c_name"), F.lit("_C"))
    )
    return table(spark, sf_dir, "customer").select(
        key.alias("doc_id"),
        F.concat(
            F.lit("<Root><Instances>"),
            element("Primary", F.col("c_name")),
            F.lit("<Secondaries>"),
            element("Database", F.concat(F.col("c_name"), F.lit("_B"))),
            element("Database", second),
            F.lit("</Secondaries></Instances><Mail><Settings>"),
            setting("profile", F.col("c_mktsegment")),
            setting("address", F.concat(F.col("c_name"), F.lit("@example.com"))),
            F.when(key % 5 != 0, setting("port", key + 25)).otherwise(F.lit("")),
            setting("ssl", key % 2),
            F.lit("</Settings></Mail></Root>"),
        ).alias("xml"),
    )


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Script templates: each document behind a byte-order mark and a header."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(
            F.lit("\ufeffUSE [<database>] -- <object>\n"),
            F.replace(F.col("text"), F.lit("the"), F.lit("<config_file>")),
        ).alias("template"),
    )


# --- Catalog snapshots -----------------------------------------------------------


def _schema_name() -> Column:
    """Two schemas, so that most table names are in both."""
    return F.when(F.col("p_partkey") % 4 == 0, "archive").otherwise("dbo").alias("schema_name")


def _column_name() -> Column:
    return F.concat(F.lit("col_"), F.col("p_partkey").cast("string"))


def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        _schema_name(),
        F.col("p_brand").alias("table_name"),
        _column_name().alias("column_name"),
        F.col("p_partkey").alias("ordinal"),
        F.lower("p_type").alias("data_type"),
        F.when(size % 10 == 0, "small").alias("domain_name"),
        F.when(size % 13 == 0, -1).otherwise(size).alias("max_length"),
        (size % 2 == 0).alias("is_nullable"),
        F.when(
            size >= 44,
            F.concat(F.lit("('d"), size.cast("string"), F.lit("')")),
        ).alias("default_value"),
    )


def catalog_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_size") == 50)
        .select(
            _schema_name(),
            F.col("p_brand").alias("table_name"),
            _column_name().alias("column_name"),
            F.lit(1000).alias("seed"),
            F.lit(1).alias("increment"),
        )
    )


def catalog_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known types; every other one has a collation, one type is unknown."""
    name = F.lower("p_type")
    return (
        table(spark, sf_dir, "part")
        .select(name.alias("type_name"))
        .distinct()
        .filter(F.col("type_name") != "promo")
        .withColumn(
            "collation", F.when(F.col("type_name").isin("small", "medium", "economy"), "CI")
        )
    )


def catalog_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_size") >= 44)
        .select(
            _schema_name(),
            F.col("p_brand").alias("table_name"),
            _column_name().alias("column_name"),
            F.concat(F.lit("df_"), F.col("p_partkey").cast("string")).alias("default_name"),
            F.when(F.col("p_size") % 2 == 0, "R").otherwise("D").alias("object_type"),
        )
    )


def catalog_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key columns: at most 16 per key, as many keys as the columns need."""
    key = F.col("p_partkey")
    block = F.shiftright(key, 4)
    kind = (
        F.when(block % 4 == 0, "PK").when(block % 4 == 1, "UQ").when(block % 4 == 2, "FK")
    ).otherwise("IX")
    return (
        table(spark, sf_dir, "part")
        .select(
            _schema_name(),
            F.col("p_brand").alias("table_name"),
            F.concat(F.lower(kind), F.lit("_"), block.cast("string")).alias("key_name"),
            kind.alias("kind"),
            (F.col("p_partkey") % 32 < 16).alias("is_clustered"),
            F.when(kind == "FK", F.concat(F.lit("ref_"), block.cast("string"))).alias(
                "referenced_table"
            ),
            _column_name().alias("column_name"),
            F.concat(F.lit("ref_col_"), key.cast("string")).alias("referenced_column"),
            (key % 16).cast("int").alias("key_ordinal"),
            (F.col("p_size") % 2 == 1).alias("is_descending"),
        )
    )


def catalog_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_size") == 11)
        .select(
            _schema_name(),
            F.col("p_brand").alias("table_name"),
            F.concat(F.lit("ck_"), F.col("p_partkey").cast("string")).alias("check_name"),
            F.concat(F.lit("(["), _column_name(), F.lit("]>(0))")).alias("definition"),
        )
    )


def catalog_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") % 2 == 0, "Configuration")
        .otherwise("Reporting")
        .alias("schema_name"),
        F.col("p_brand").alias("table_name"),
        F.concat(F.lit("ix_"), F.col("p_partkey").cast("string")).alias("index_name"),
        (F.col("p_partkey") % 6).cast("int").alias("data_space_id"),
    )


def data_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("data_space_id"),
        F.when(F.col("r_regionkey") == 0, "Configure").otherwise(F.col("r_name")).alias(
            "data_space"
        ),
    )
