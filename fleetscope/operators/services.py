"""Services that should run and do not."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.operators.keys import sort_position
from fleetscope.operators.paging import html_report

# The service families that are watched.
WATCHED_PREFIXES = ("SQLAGENT", "MSSQL")
RUNNING = "RUNNING"


def stopped_services(services: DataFrame) -> DataFrame:
    """Watched services in any other state than running; case does not matter."""
    name = F.upper("name")
    watched = name.startswith(WATCHED_PREFIXES[0])
    for prefix in WATCHED_PREFIXES[1:]:
        watched = watched | name.startswith(prefix)
    return services.filter((F.upper("status") != RUNNING) & watched)


def stopped_services_report(
    stopped: DataFrame, as_of: dt.datetime, page_rows: int | None = None
) -> DataFrame:
    """Per server, an HTML table of the stopped services ordered by name."""
    ordered = sort_position(
        stopped.select("server", "name", "row_id", "status", "service_name"),
        "server",
        "name",
        "row_id",
    )
    return html_report(
        ordered,
        "position",
        ["server"],
        [
            ("Status", F.col("status")),
            ("Service", F.col("name")),
            ("DisplayName", F.col("service_name")),
        ],
        f"Watched services that do not run, as of {as_of:%Y-%m-%d %H:%M:%S}",
        page_rows,
    )
