"""What polls keep: newest runs, failures against a long record, failures with bounded state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetscope.operators import job_activity as ja
from fleetscope.operators import job_failures as jf
from fleetscope.operators import sketch
from fleetscope.plans import activity_poll
from fleetscope.schemas import table_schema
from fleetscope.session import cut_lineage, fresh_folder
from fleetscope.sinks import snapshots
from fleetscope.streaming import feeds
from tests.conftest import as_dicts

NOW = dt.datetime(2024, 1, 15, 13, 30)


def at(hour, minute=0, day=15):
    return dt.datetime(2024, 1, day, hour, minute)


def test_late_and_repeated_polls_equal_the_whole_activity(spark, rows):
    draw = random.Random(5)
    jobs = [(j, "j", 1, s) for j in range(12) for s in ("A", "B")]
    whole = []
    for j, _, _, s in jobs[:-2]:
        for start in draw.sample(range(200), draw.randrange(1, 9)):
            start = at(0, day=1) + dt.timedelta(minutes=97 * start)
            whole.append((j, start, draw.choice([None, start + dt.timedelta(minutes=draw.randrange(3000))]), s))
    whole += [(1, None, None, "A"), (2, at(9), at(10), "A"), (2, at(9), at(11), "A")]
    location = fresh_folder(spark, "runs")
    polls = [draw.sample(whole, 25) for _ in range(3)] + [sorted(whole, key=str)[:40], whole[::-1], whole[:20]]
    for poll in polls:
        # an earlier look at a run does not know its stop yet
        seen = [(j, start, draw.choice([None, stop]), s) for j, start, stop, s in poll] if poll is not polls[4] else poll
        activity_poll.merge_activity(rows("job_activity", *seen), location)
    got = activity_poll.latest_activity_per_job(rows("jobs", *jobs), location, NOW)
    want = ja.latest_activity_per_job(rows("jobs", *jobs), rows("job_activity", *whole), NOW)
    assert as_dicts(got, "server", "job_id") == as_dicts(want, "server", "job_id")
    started = {(j, s) for j, start, _, s in whole if start}
    assert activity_poll.newest_runs(spark, location).count() == len(started)


def test_a_poll_rewrites_the_days_of_its_jobs_only(spark, rows):
    location = fresh_folder(spark, "runs")
    first = [(1, at(9, day=2), None, "S"), (2, at(9, day=3), None, "S"), (3, at(9, day=3), at(10, day=3), "S")]
    activity_poll.merge_activity(rows("job_activity", *first), location)
    before = activity_poll.newest_runs(spark, location).inputFiles()
    activity_poll.merge_activity(rows("job_activity", (2, at(9, day=4), None, "S")), location)
    kept = set(before) & set(activity_poll.newest_runs(spark, location).inputFiles())
    assert {f.split("day=")[1][:10] for f in kept} == {"2024-01-02"}
    snapshot = snapshots.current(spark, location)
    assert [p.day.day for p in sorted(snapshot.of("job_activity"), key=lambda p: p.day)] == [2, 3, 4]
    assert activity_poll.merge_activity(rows("job_activity"), location) == snapshot
    assert activity_poll.merge_activity(rows("job_activity", (7, None, None, "S")), location) == snapshot


def test_a_poll_that_another_one_overtook_fails(spark, rows, monkeypatch):
    location = fresh_folder(spark, "runs")
    stale = snapshots.current(spark, location)
    activity_poll.merge_activity(rows("job_activity", (1, at(9), None, "S")), location)
    monkeypatch.setattr(activity_poll.snapshots, "current", lambda *_: stale)
    with pytest.raises(snapshots.Conflict):
        activity_poll.merge_activity(rows("job_activity", (2, at(9), None, "S")), location)
    monkeypatch.undo()
    assert [r.job_id for r in activity_poll.newest_runs(spark, location).collect()] == [1]


def failures(spark, first, last, step=1):
    return spark.range(first, last, step).select(
        F.concat(F.lit("S"), (F.col("id") % 3).cast("string")).alias("server"), F.col("id").alias("instance_id")
    )


def test_the_sketch_lets_few_other_rows_of_a_long_record_through(spark):
    batch = cut_lineage(failures(spark, 0, 200_000, 401))
    record = failures(spark, 100, 200_000)
    passed = sketch.may_match(record, batch, jf.FAILURE, batch.count())
    matches = record.join(batch, jf.FAILURE, "left_semi").count()
    assert passed.join(batch, jf.FAILURE, "left_semi").count() == matches
    assert matches <= passed.count() <= matches + 200_000 // 50
    nothing = sketch.may_match(record, batch.filter("instance_id < 0"), jf.FAILURE, 0)
    assert nothing.count() == 0


@pytest.mark.parametrize("expected", [None, 0, 1, 300, 10**9])
def test_new_failures_are_the_same_at_any_size_of_the_sketch(spark, monkeypatch, expected):
    monkeypatch.setattr(sketch, "MAX_WORDS", 1 << 10)
    nulls = spark.createDataFrame([(None, 5), ("S0", None)], "server string, instance_id long")
    view = cut_lineage(failures(spark, 0, 9000, 13).unionByName(nulls))
    record = failures(spark, 0, 50_000, 3).unionByName(nulls)
    got = sorted(map(str, jf.failed_jobs_new(view, record, expected).collect()))
    known = set(range(0, 50_000, 3))
    want = [r for r in view.collect() if r.server is None or r.instance_id is None or r.instance_id not in known]
    assert got == sorted(map(str, want))


def test_the_bounded_feed_loses_what_is_later_than_its_bound(spark, rows, tmp_path):
    source, location, state = str(tmp_path / "in"), fresh_folder(spark, "rec"), fresh_folder(spark, "st")
    jobs, steps = rows("jobs", (1, "load", 1)), rows("job_steps", (1, 1, "copy"))

    def arrive(*values):
        history = [(i, 1, 1, status, day, time, 10, 0, 0, "m", "S") for i, status, day, time in values]
        rows("job_history", *history).coalesce(1).write.mode("append").parquet(source)

    def run():
        feed = feeds.file_feed(spark, source, table_schema("job_history"), files_per_batch=1)
        feeds.record_failed_jobs_bounded(feed, jobs, steps, location, state, NOW, "2 hours")
        return sorted(r.instance_id for r in feeds.bounded_record(spark, location).collect())

    arrive((1, 0, 20240115, 100000), (1, 0, 20240115, 100000), (2, 1, 20240115, 100000), (9, 0, 0, 905))
    assert run() == [1]
    arrive((1, 0, 20240115, 100000), (3, 0, 20240115, 140000))  # a repeat, within the bound
    assert run() == [1, 3]
    arrive((4, 0, 20240115, 130000), (5, 0, 20240115, 110000))  # the second is three hours late
    assert run() == [1, 3, 4]
    arrive((1, 0, 20240115, 100000), (4, 0, 20240115, 130000))  # repeats, beyond and within the bound
    assert run() == [1, 3, 4]
    assert run() == [1, 3, 4]
