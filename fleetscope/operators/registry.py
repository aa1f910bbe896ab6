"""Registered instances, releases and mail recipients."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import clock
from fleetscope.operators.keys import assign_keys
from fleetscope.operators.paging import paged_text, text_lines
from fleetscope.operators.spread import spread_lookup
from fleetscope.schemas import OPEN_END
from fleetscope.session import cut_lineage

FIRST_RELEASE_ID = 1000
DEFAULT_VERSION = "1.0"
RECIPIENT_SEPARATOR = "; "


def instance_path() -> Column:
    return F.concat(F.col("server_name"), F.lit("\\"), F.col("instance_name"))


def name_uuid(name: Column) -> Column:
    """An id in uuid form made from the name, the same on every attempt of a task."""
    return F.regexp_replace(
        F.md5(name.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


def instance_monitored(instances: DataFrame) -> DataFrame:
    return instances.filter("is_monitored").select(
        "server_instance_id",
        instance_path().alias("sql_instance"),
        "backup_location",
        "primary_console",
    )


def instance_pending_install(instances: DataFrame) -> DataFrame:
    """Monitored secondary instances that still carry the open-end date."""
    return instances.filter(
        F.col("is_monitored")
        & ~F.col("primary_console")
        & (F.col("installed") == clock.ntz(OPEN_END))
    ).select("server_instance_id", instance_path().alias("sql_instance"), "backup_location")


def _folded(name: str) -> Column:
    return F.upper(F.trim(name)).alias(name)


def normalised_instances(offered: DataFrame) -> DataFrame:
    """Names trimmed and upper-cased; equal names are offered once."""
    return (
        offered.select(
            _folded("server_name"),
            _folded("instance_name"),
            "backup_location",
        )
        .groupBy("server_name", "instance_name")
        .agg(F.min("backup_location").alias("backup_location"))
    )


def instance_register(
    instances: DataFrame, offered: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """The registry after instances that were not in it yet are added.

    Names match in any case and padding, on both sides; stored rows keep their
    spelling. New rows get an id made from their name and the defaults of the table.
    """
    known = instances.select(_folded("server_name"), _folded("instance_name"))
    new = normalised_instances(offered).join(known, ["server_name", "instance_name"], "left_anti")
    return instances.unionByName(
        new.select(
            name_uuid(instance_path()).alias("server_instance_id"),
            "server_name",
            "instance_name",
            "backup_location",
            F.lit(False).alias("primary_console"),
            F.lit(True).alias("is_monitored"),
            clock.ntz(OPEN_END).alias("installed"),
            F.lit(as_of.date().isoformat()).cast("date").alias("create_date"),
        )
    )


def instance_primary_flag(
    instances: DataFrame, primary: str, as_of: dt.datetime
) -> DataFrame:
    """The registry with ``server\\instance``, in any case, marked as the primary console."""
    hit = F.upper(instance_path()) == F.upper(F.lit(primary))
    changed = {
        "primary_console": F.when(hit, True).otherwise(F.col("primary_console")),
        "installed": F.when(hit, clock.ntz(as_of)).otherwise(F.col("installed")),
    }
    return instances.withColumns(changed)


def release_pending(offered: DataFrame, releases: DataFrame) -> DataFrame:
    """Offered scripts (list_id, script_name, ...) not yet applied without error.

    Script names are compared without case. The applied names are made distinct
    first, so a name with many rows is combined before it is shuffled; a name
    offered many times is spread.
    """
    script = F.lower("script_name").alias("_script")
    applied = releases.filter(~F.col("is_error")).select(script).distinct()
    return spread_lookup(
        offered.select("*", script), applied, ["_script"], "list_id", "left_anti"
    ).select(*offered.columns)


def _latest_run(source: DataFrame) -> DataFrame:
    """Cleaned source rows, the last one (by ``seq``) per script, its folded name as ``_script``."""
    blank = F.rtrim("error_message") == ""
    error = F.when(~blank, F.replace("error_message", F.lit("|"), F.lit(" ")))
    version = F.coalesce("version_number", F.lit(DEFAULT_VERSION).cast("decimal(3,1)"))
    cleaned = source.withColumns({"error_message": error, "version_number": version})
    values = [c for c in cleaned.columns if c != "seq"]
    last = F.max_by(F.struct(*values), "seq").alias("last")
    return (
        cleaned.groupBy(F.lower("script_name").alias("_script"))
        .agg(F.max("seq").alias("seq"), last)
        .select("_script", "seq", "last.*")
    )


def release_upsert(releases: DataFrame, source: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The release table after script runs are recorded, one row per script.

    A known script keeps its id, the stored spelling of its name and its first
    install time, everything else is replaced. A new script gets the next id in
    ``seq`` order. Names are compared without case. Both inputs are read and
    joined once; the joined rows are written and serve both kinds of script.
    """
    now = clock.ntz(as_of)
    runs = _latest_run(source)
    replaced = [
        "version_number", "author", "object_name", "description", "option", "is_error",
        "error_message", "release_date",
    ]
    hit = F.col("_run").isNotNull()
    change = runs.select("_script", F.struct("seq", "script_name", *replaced).alias("_run"))
    known = releases.withColumns({"_script": F.lower("script_name"), "_known": F.lit(True)})
    both = cut_lineage(known.join(change, "_script", "full"))
    kept = both.filter("_known").select(
        *[
            F.when(hit, F.col(f"_run.{c}")).otherwise(F.col(c)).alias(c)
            if c in replaced
            else F.when(hit, now).otherwise(F.col(c)).alias(c)
            if c == "updated"
            else F.col(c)
            for c in releases.columns
        ]
    )
    new = both.filter(F.col("_known").isNull()).select("_run.*")
    keyed = assign_keys(new, "seq", "release_id", both, first=FIRST_RELEASE_ID)
    added = keyed.withColumns({"installed": now, "updated": now}).select(*releases.columns)
    return kept.unionByName(added)


def recipients_concat(
    emails: DataFrame, by: Sequence[str] = (), page_rows: int | None = None
) -> DataFrame:
    """Active addresses in lower case and id order: position and recipient.

    With ``page_rows`` they come joined by ``; ``, so many in a page. Then, without ``by``, a table
    with no active address gives one row with NULL.
    """
    active = emails.filter("is_active")
    if page_rows is None:
        return text_lines(active, F.lower("address"), "email_id", by, "recipient")
    pages = paged_text(
        active, F.lower("address"), "email_id", by, RECIPIENT_SEPARATOR,
        page_rows=page_rows, name="recipients",
    )
    if by:
        return pages
    first_page = emails.sparkSession.range(1).select(F.lit(1).cast("long").alias("page"))
    return first_page.join(pages, "page", "full")


def existence_semi_join(
    profiles: DataFrame, links: DataFrame, accounts: DataFrame
) -> DataFrame:
    """Profiles linked to at least one of the accounts."""
    linked = links.join(accounts.select("account_id"), "account_id", "left_semi")
    return profiles.join(linked.select("profile_id").distinct(), "profile_id", "left_semi")
