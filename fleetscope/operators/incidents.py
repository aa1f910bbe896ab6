"""Blocking reports and deadlock graphs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import clock, markup
from fleetscope.operators.keys import assign_keys
from fleetscope.operators.spread import spread_lookup
from fleetscope.session import cut_lineage
from fleetscope.sources.config_xml import XML_OPTIONS

# Attributes read from a process element, in report order.
BLOCKED_ATTRIBUTES = (
    "waittime", "transactionname", "lockMode", "status", "clientapp", "hostname", "loginname",
)
BLOCKING_ATTRIBUTES = ("status", "clientapp", "hostname", "loginname")
DETAIL_COLUMNS = (
    "nature", "waittime", "transactionname", "lock_mode", "status", "clientapp", "hostname",
    "loginname", "currentdb", "inputbuf",
)
# Fixed value: the column order of the rendered table.
REPORT_COLUMNS = (
    "currentdb", "nature", "waittime", "transactionname", "lock_mode", "status", "clientapp",
    "hostname", "loginname", "inputbuf",
)

# The lead line of a graph and the entities taken out of it.
GRAPH_LEAD = (
    "--Note: Save this output as .xdl file and open in SSMS to view graphically "
    "and remove this line."
)
GRAPH_ENTITIES = ("&#x0A;", "&#x20;")

# How the rendered tables look.
TABLE_STYLE = 'class="incident" rules="all"'

# Names of databases that may be broadcast, and ids in one part of a server's dictionary.
MAX_NAMES = 1 << 18
PART_IDS = 256

_PROCESS = (
    "array<struct<process: array<struct<`_spid`: string, `_currentdb`: string, "
    + ", ".join(f"`_{a}`: string" for a in BLOCKED_ATTRIBUTES)
    + ", inputbuf: array<string>>>>>"
)
_REPORT = (
    "`blocked-process-report` array<struct<"
    f"`blocked-process`: {_PROCESS}, `blocking-process`: {_PROCESS}>>"
)


# Only what the session id needs; the parser's cost grows with the fields asked for.
_BLOCKERS = (
    "`blocked-process-report` array<struct<"
    "`blocking-process`: array<struct<process: array<struct<`_spid`: string>>>>>>"
)


def _processes(parsed: Column, side: str) -> Column:
    """The process elements of one side, over all reports in the document."""
    reports = F.coalesce(parsed["blocked-process-report"], F.array())
    sides = F.flatten(F.transform(reports, lambda r: F.coalesce(r[side], F.array())))
    return F.flatten(F.transform(sides, lambda s: F.coalesce(s["process"], F.array())))


def with_processes(reports: DataFrame) -> DataFrame:
    """Reports with the array columns ``blocked`` and ``blocking``.

    The operators below parse a report themselves unless it comes with these
    columns, so a caller that needs several outputs can parse once and persist.
    """
    if "blocking" in reports.columns:
        return reports
    parsed = reports.withColumn("_doc", F.from_xml("report", _REPORT, XML_OPTIONS))
    return parsed.withColumns(
        {
            "blocked": _processes(F.col("_doc"), "blocked-process"),
            "blocking": _processes(F.col("_doc"), "blocking-process"),
        }
    ).drop("_doc")


def process_list(reports: DataFrame) -> DataFrame:
    """Reports with the array ``processes``: blocked processes first, then blocking ones, in document order.

    The blocking side has no wait time, transaction or lock mode. Reports that come with the array stay as they are.
    """
    if "processes" in reports.columns:
        return reports

    def tagged(nature: str, processes: Column, attributes) -> Column:
        def row(process: Column) -> Column:
            values = [
                (F.coalesce(process[f"_{a}"], F.lit("")) if a in attributes else F.lit("")).alias(
                    "lock_mode" if a == "lockMode" else a
                )
                for a in BLOCKED_ATTRIBUTES
            ]
            return F.struct(
                F.lit(nature).alias("nature"),
                *values,
                process["_currentdb"].try_cast("long").alias("database_id"),
                F.coalesce(F.get(process["inputbuf"], F.lit(0)), F.lit("")).alias("inputbuf"),
            )

        return F.transform(processes, row)

    both = F.concat(
        tagged("Blocked", F.col("blocked"), BLOCKED_ATTRIBUTES),
        tagged("BlockedBy", F.col("blocking"), BLOCKING_ATTRIBUTES),
    )
    return with_processes(reports).withColumn("processes", both)


def process_rows(reports: DataFrame) -> DataFrame:
    """One row per process in each report, with its ``position`` in the list and the raw database id.

    A plain explode makes the optimizer ask for lists that are not empty, below the parser: that
    filter parses each report again, twice for each mention of the list. So empty lists give a row here that goes afterwards.
    """
    listed = process_list(reports)
    rows = listed.select("event_id", "server", F.posexplode_outer("processes").alias("position", "row"))
    return rows.filter(F.col("position").isNotNull()).select("event_id", "server", "position", "row.*")


def server_dictionaries(databases: DataFrame) -> DataFrame:
    """One row per server with ``names``: part of the ids -> id -> name.

    A look-up in a map compares key by key, so the ids of a server are split into
    parts of PART_IDS: one with many databases costs two short searches. A server has at most as many
    databases as its engine allows (32,767), so a row is bounded. Of several names of an id the largest counts.
    """
    one = databases.filter(F.col("database_id").isNotNull()).groupBy("server", "database_id").agg(F.max("name").alias("name"))
    part = F.floor(F.col("database_id") / PART_IDS).alias("part")
    parts = one.groupBy("server", part).agg(
        F.map_from_entries(F.collect_list(F.struct("database_id", "name"))).alias("ids")
    )
    return parts.groupBy("server").agg(F.map_from_entries(F.collect_list(F.struct("part", "ids"))).alias("names"))


def database_name_lookup(
    reports: DataFrame, databases: DataFrame, max_names: int = MAX_NAMES
) -> DataFrame:
    """Reports with the array ``processes``, each with the name of its database on its server as ``currentdb``.

    The name of an unknown id is empty. The names are looked up inside the list, in the server's
    dictionary, so reports are neither exploded nor shuffled. Dictionaries are broadcast
    up to ``max_names`` names, which are counted first. Beyond that the parsed reports are written out, and names are
    looked up once for each different list of ids of a server, in shuffles of narrow rows; then each report is
    shuffled once to the names of its list. Frequent ids and lists are spread.
    """
    listed = process_list(reports)
    few = databases.limit(max_names + 1).count() <= max_names

    def named(name_of) -> Column:
        return F.transform(
            "processes",
            lambda p, i: p.withField("currentdb", F.coalesce(name_of(p, i), F.lit(""))),
        )

    if few:
        rows = listed.join(F.broadcast(server_dictionaries(databases)), "server", "left")

        def in_dictionary(process: Column, _: Column) -> Column:
            part = F.floor(process["database_id"] / PART_IDS)
            return F.try_element_at(F.try_element_at(F.col("names"), part), process["database_id"])

        return rows.withColumn("processes", named(in_dictionary)).drop("names")
    # Parsed once; the look-ups read the ids only.
    listed = cut_lineage(listed.withColumn("_ids", F.transform("processes", lambda p: p["database_id"])))
    lists = cut_lineage(listed.select("server", "_ids").distinct())
    asked = lists.select("*", F.explode(F.array_distinct("_ids")).alias("database_id"))
    one = databases.groupBy("server", "database_id").agg(F.max("name").alias("name"))
    found = spread_lookup(asked, one, ["server", "database_id"], "_ids")
    names = found.groupBy("server", "_ids").agg(
        F.map_from_entries(F.collect_list(F.struct("database_id", "name"))).alias("names")
    )
    rows = spread_lookup(listed, names, ["server", "_ids"], "event_id", "left", hashed=True)
    by_id = named(lambda p, _: F.try_element_at(F.col("names"), p["database_id"]))
    return rows.withColumn("processes", by_id).select(*listed.drop("_ids").columns)


def blocked_process_details(reports: DataFrame, databases: DataFrame) -> DataFrame:
    """Blocked and blocking processes of each report, ten text columns."""
    listed = process_list(reports).select("event_id", "server", "processes")
    named = process_rows(database_name_lookup(listed, databases))
    return named.select("event_id", "position", *DETAIL_COLUMNS)


def blocked_report_render(reports: DataFrame, databases: DataFrame) -> DataFrame:
    """Per event, its processes as an HTML table followed by the escaped document.

    Lines are made inside the list of a report, so a report stays one row from the scan to the result.
    """
    lines = F.transform("processes", lambda p: markup.table_row([p[c] for c in REPORT_COLUMNS]))
    opening = f"<table {TABLE_STYLE}>"
    titles = markup.heading_row(REPORT_COLUMNS)
    return database_name_lookup(reports, databases).select(
        "event_id",
        F.concat(
            F.lit(opening + titles),
            F.array_join(lines, ""),
            F.lit(f"</table>{opening}<tr><th>Report</th></tr><tr><td>"),
            markup.escape(F.col("report")),
            F.lit("</td></tr></table>"),
        ).alias("body"),
    )


def blocked_events_store(
    reports: DataFrame,
    existing: DataFrame | None = None,
    as_of: dt.datetime | None = None,
    first: int = 1,
) -> DataFrame:
    """Rows to store: new id, session id, raw document and alert time.

    The session id is the first blocking process's, NULL if there is none. The
    alert time is ``as_of``, or the report's own if none is given.
    """
    alert = F.col("alert") if as_of is None else clock.ntz(as_of)
    if "blocking" in reports.columns:
        blocking = F.col("blocking")
    else:
        blocking = _processes(F.from_xml("report", _BLOCKERS, XML_OPTIONS), "blocking-process")
    # The first session id of the document; a process may lack one.
    sessions = F.filter(F.transform(blocking, lambda p: p["_spid"]), lambda s: s.isNotNull())
    rows = reports.select(
        "event_id",
        F.get(sessions, F.lit(0)).try_cast("int").alias("spid"),
        F.col("report").alias("blocked_report"),
        alert.alias("alert_datetime"),
    )
    return assign_keys(rows, "event_id", "blocked_events_id", existing, first, wide=True)


def deadlock_text_normalise(graphs: DataFrame) -> DataFrame:
    """The graph as text behind its lead line, without the two entities."""
    text = F.concat(F.lit(GRAPH_LEAD), F.col("graph"))
    body = markup.replace_all(text, {entity: "" for entity in GRAPH_ENTITIES})
    return graphs.select("doc_id", body.alias("body"))


def deadlock_events_store(
    graphs: DataFrame, as_of: dt.datetime, existing: DataFrame | None = None, first: int = 1
) -> DataFrame:
    """Rows to store: new id, raw graph and alert time."""
    keyed = assign_keys(graphs, "doc_id", "deadlock_events_id", existing, first, wide=True)
    return keyed.select(
        "deadlock_events_id",
        "doc_id",
        F.col("graph").alias("deadlock_graph"),
        clock.ntz(as_of).alias("alert_datetime"),
    )
