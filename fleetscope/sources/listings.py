"""Service listings: fixed-text command output turned into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER_LINES = 3


def numbered_lines(outputs: DataFrame, text: str = "output") -> DataFrame:
    """One row per line of each server's captured output, numbered from 1.

    Empty lines become NULL, the way command output is captured.
    """
    lines = F.posexplode(F.split(F.replace(F.col(text), F.lit("\r")), "\n"))
    return outputs.select("server", lines).select(
        "server",
        (F.col("pos") + 1).cast("long").alias("row_id"),
        F.when(F.col("col") != "", F.col("col")).alias("value"),
    )


def _first_blank(text: Column) -> Column:
    return F.instr(F.trim(text), " ")


def _first_word(text: Column) -> Column:
    return F.substring_index(F.trim(text), " ", 1)


def _without(text: Column, word: Column) -> Column:
    """``text`` without ``word`` wherever it occurs, in any case."""
    folded = F.collate(text, "UTF8_LCASE")
    return F.collate(F.replace(folded, F.collate(word, "UTF8_LCASE"), F.lit("")), "UTF8_BINARY")


def derive_levels(lines: DataFrame) -> DataFrame:
    """Name, then status, then display name, each derived from the one before.

    A derived text is removed wherever it occurs in the line, in any case, so a
    display name that repeats the service name loses it. ``is_complete`` is false where a
    level has no blank to end at.
    """
    body = lines.filter(F.col("value").isNotNull() & (F.col("row_id") > HEADER_LINES))
    return (
        body.withColumn("name", _first_word(F.col("value")))
        .withColumn("after_name", _without(F.col("value"), F.col("name")))
        .withColumn("status", _first_word(F.col("after_name")))
        .withColumn(
            "service_name",
            F.trim(_without(_without(F.col("value"), F.col("status")), F.col("name"))),
        )
        .withColumn(
            "is_complete",
            (_first_blank(F.col("value")) > 0) & (_first_blank(F.col("after_name")) > 0),
        )
    )


def parse_listing(lines: DataFrame) -> DataFrame:
    """Services of well-formed lines."""
    return derive_levels(lines).filter("is_complete").select(
        "server", "row_id", "status", "name", "service_name"
    )


def listing_rejects(lines: DataFrame) -> DataFrame:
    """Lines that have no status or no display name, kept apart."""
    return derive_levels(lines).filter("not is_complete").select("server", "row_id", "value")
