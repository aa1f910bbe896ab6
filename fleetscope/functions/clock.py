"""Dates and durations that the scheduler stores as integers.

All expressions work on TIMESTAMP_NTZ and never go through the session time
zone, so results do not depend on where a job runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(value: Column, by: int) -> Column:
    """Integer division, truncating towards zero."""
    return F.call_function("div", value, F.lit(by))


def ntz(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day_number(day: dt.date) -> int:
    """The ``yyyymmdd`` integer of a day."""
    return day.year * 10000 + day.month * 100 + day.day


def agent_datetime(run_date: Column, run_time: Column) -> Column:
    """``(yyyymmdd, hhmmss)`` integers to a timestamp.

    A date of 0 means "never" and gives NULL, where a string conversion would
    fail.
    """
    day = F.nullif(run_date, F.lit(0))
    return F.make_timestamp_ntz(
        int_div(day, 10000).cast("int"),
        (int_div(day, 100) % 100).cast("int"),
        (day % 100).cast("int"),
        int_div(run_time, 10000).cast("int"),
        (int_div(run_time, 100) % 100).cast("int"),
        run_time % 100,
    )


def hhmmss_seconds(value: Column) -> Column:
    """``hhmmss`` integer duration to seconds; hours may have any digits."""
    value = value.cast("long")
    return int_div(value, 10000) * 3600 + (int_div(value, 100) % 100) * 60 + value % 100


def seconds_hhmmss(seconds: Column) -> Column:
    """Seconds to an ``hhmmss`` integer."""
    return int_div(seconds, 3600) * 10000 + (int_div(seconds, 60) % 60) * 100 + seconds % 60


def wrapped_label(seconds: Column) -> Column:
    """``HH:mm:ss`` of a duration, wrapped at 24 hours like a time of day."""
    part = seconds % 86400

    def two(value: Column) -> Column:
        return F.lpad(value.cast("string"), 2, "0")

    colon = F.lit(":")
    return F.concat(
        two(int_div(part, 3600)), colon, two(int_div(part, 60) % 60), colon, two(part % 60)
    )


def seconds_between(start: Column, stop: Column) -> Column:
    """Whole seconds from ``start`` to ``stop``."""
    span = stop - start
    return (
        F.extract(F.lit("DAY"), span) * 86400
        + F.extract(F.lit("HOUR"), span) * 3600
        + F.extract(F.lit("MINUTE"), span) * 60
        + F.extract(F.lit("SECOND"), span).cast("long")
    ).cast("long")


def minute_round(moment: Column) -> Column:
    """Rounded to the nearest minute; from 30 seconds up, to the next one."""
    shifted = moment + F.expr("interval 30 seconds")
    return shifted - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), shifted))


def stamp(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text."""
    return F.substring(moment.cast("string"), 1, 19)
