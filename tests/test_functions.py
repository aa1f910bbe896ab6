"""Decoders, code sets and text helpers on hand-written values."""

import datetime as dt

from pyspark.sql import functions as F

from fleetscope.functions import clock, codes, markup
from tests.conftest import as_dicts


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_agent_datetime_pads_the_time(spark, rows):
    df = rows("d int, t int", (20240115, 905), (20231231, 235959), (0, 120000), (20240229, 0))
    got = [r.v for r in df.select(clock.agent_datetime(F.col("d"), F.col("t")).alias("v")).collect()]
    assert got == [
        dt.datetime(2024, 1, 15, 0, 9, 5),
        dt.datetime(2023, 12, 31, 23, 59, 59),
        None,
        dt.datetime(2024, 2, 29),
    ]


def test_duration_beyond_two_hour_digits(spark, rows):
    df = rows("d int", (1234559,), (240000,), (59,), (235959,))
    got = as_dicts(
        df.select(
            clock.hhmmss_seconds(F.col("d")).alias("s"),
            clock.wrapped_label(clock.hhmmss_seconds(F.col("d") % 240000)).alias("w"),
        )
    )
    assert got == [
        {"s": 123 * 3600 + 45 * 60 + 59, "w": "03:45:59"},
        {"s": 86400, "w": "00:00:00"},
        {"s": 59, "w": "00:00:59"},
        {"s": 86399, "w": "23:59:59"},
    ]


def test_seconds_round_trip(spark):
    df = spark.range(0, 500000, 7777)
    back = clock.hhmmss_seconds(clock.seconds_hhmmss(F.col("id")))
    assert df.filter(back != F.col("id")).count() == 0


def test_minute_round_goes_up_from_thirty_seconds(spark, rows):
    df = rows(
        "t timestamp_ntz",
        (dt.datetime(2024, 1, 15, 10, 0, 29, 999000),),
        (dt.datetime(2024, 1, 15, 10, 0, 30),),
        (dt.datetime(2024, 1, 15, 23, 59, 45),),
    )
    got = [r.v for r in df.select(clock.minute_round(F.col("t")).alias("v")).collect()]
    assert got == [
        dt.datetime(2024, 1, 15, 10, 0),
        dt.datetime(2024, 1, 15, 10, 1),
        dt.datetime(2024, 1, 16),
    ]


def test_seconds_between_ignores_the_session_zone(spark, rows):
    df = rows(
        "a timestamp_ntz, b timestamp_ntz",
        (dt.datetime(2024, 3, 30, 12), dt.datetime(2024, 3, 31, 12, 0, 0, 900000)),
    )
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = df.select(clock.seconds_between(F.col("a"), F.col("b")).alias("v")).first()["v"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == 86400


def test_codes_outside_every_set(spark, rows):
    df = rows("c int", (0,), (1,), (4,), (6,), (None,))
    got = as_dicts(
        df.select(
            codes.history_label(F.col("c")).alias("history"),
            codes.uniform_code(F.col("c")).alias("code"),
            codes.uniform_label(F.col("c")).alias("label"),
            codes.running_code(F.col("c")).alias("running"),
            codes.running_label(F.col("c")).alias("running_label"),
            codes.outcome_label(F.col("c")).alias("outcome"),
        )
    )
    assert [g["history"] for g in got] == ["Failed", "Succeeded", "In progress", None, None]
    assert [g["code"] for g in got] == [0, 1, 2, 4, 4]
    assert [g["label"] for g in got] == ["Failed", "Success", "In Progress", "Unknown", "Unknown"]
    assert [g["running"] for g in got] == [1, 2, 1, None, None]
    assert [g["running_label"] for g in got][-2:] == ["Unknown", "Unknown"]
    assert [g["outcome"] for g in got] == ["Failed", "Success", "Unknown", "Unknown", "Unknown"]


def test_cells_are_escaped_and_never_missing(spark):
    row = markup.table_row([F.lit("a<b> & c"), F.lit(None), F.lit(7)])
    assert one(spark, row) == (
        '<tr valign="top"><td>a&lt;b&gt; &amp; c</td><td></td><td>7</td></tr>'
    )


def test_bracketed_name_doubles_the_closing_bracket(spark):
    assert one(spark, markup.bracketed(F.lit("a]b"))) == "[a]]b]"


def test_replacements_follow_their_order(spark):
    assert one(spark, markup.replace_all(F.lit("a.b"), {".": "a", "a": "x"})) == "xxb"
