import datetime as dt

from fleetscope.operators import job_activity as ja
from fleetscope.plans.fleet_status import fleet_status
from tests.conftest import as_dicts, plan_of

NOW = dt.datetime(2024, 1, 15, 13, 30)


def at(hour, minute=0, second=0, day=15):
    return dt.datetime(2024, 1, day, hour, minute, second)


def hist(instance, job, step, status, run_time, message="m", day=20240115, duration=130):
    return (instance, job, step, status, day, run_time, duration, 0, 0, message, "S")


def test_latest_activity_defaults_ties_and_wrapping(spark, rows):
    jobs = rows("jobs", (1, "a", 1), (2, "b", 1), (3, "c", 0), (4, "d", 1), (5, "e", 1))
    activity = rows(
        "job_activity",
        (1, at(8), at(9)),
        (1, at(10), at(10, 0, 5)),
        (2, at(9), at(9, 1)),
        (2, at(9), at(9, 30)),
        (3, at(12), None),
        (4, None, None),
        (5, at(1, day=13), at(3, day=14)),
    )
    got = as_dicts(ja.latest_activity_per_job(jobs, activity, NOW), "job_id")
    assert [g["job_duration"] for g in got] == [
        "00:00:05", "00:30:00", "01:30:00", "00:00:00", "02:00:00",
    ]
    assert got[4]["duration_seconds"] == 26 * 3600
    assert got[3]["job_start"] == dt.datetime(1900, 1, 1)
    assert got[0]["job_start"] == at(10)


def test_status_of_idle_and_running_jobs(spark, rows):
    listing = rows("job_listing", (1, 0, 0, 4), (2, 1, 2, 3), (3, 1, 0, 6), (4, 0, 0, 0), (9, 1, 0, 1))
    jobs = rows("jobs", (1, "a", 1), (2, "b", 0), (3, "c", 1), (4, "d", 1))
    servers = rows("job_servers", (1, 3), (2, 0), (3, 1))
    got = as_dicts(
        ja.current_jobs_status(listing, jobs, servers, rows("job_activity"), NOW), "job_id"
    )
    assert [(g["run_status"], g["run_status_desc"], g["is_enabled"]) for g in got] == [
        (3, "Canceled", "Enabled"),
        (2, "Retrying", "Disabled"),
        (None, "Unknown", "Enabled"),
        (None, "Unknown", "Enabled"),
    ]


STEPS = [(1, 1, "copy"), (1, 2, "check"), (2, 1, "load")]


def test_step_rows_since_the_rounded_start(spark, rows):
    """A step in the rounded-up half minute is lost; jobs without a run keep their steps."""
    activity = rows("job_activity", (1, at(10, 0, 40), None), (1, at(8), at(9)))
    history = rows(
        "job_history",
        hist(1, 1, 1, 1, 100050),
        hist(2, 1, 1, 1, 100100),
        hist(3, 1, 1, 2, 100500),
        hist(4, 1, 2, 0, 85000),
        hist(5, 2, 1, 1, 120000),
    )
    got = as_dicts(
        ja.job_step_outer(rows("job_steps", *STEPS), history, activity),
        "job_id", "step_id", "instance_id",
    )
    assert [(g["job_id"], g["step_id"], g["instance_id"]) for g in got] == [
        (1, 1, 2), (1, 1, 3), (1, 2, None), (2, 1, None),
    ]


def test_step_status_texts(spark, rows):
    listing = rows("job_listing", (1, 0, 0, 4), (2, 0, 0, 4))
    jobs = rows("jobs", (1, "a", 1), (2, "b", 1))
    activity = rows("job_activity", (1, at(9), None))
    history = rows(
        "job_history",
        hist(1, 1, 1, 0, 100000, message="broke"),
        hist(2, 1, 2, 3, 100000, message=None),
        hist(3, 1, 1, 4, 110000),
        hist(4, 1, 2, 9, 110000, duration=1234559),
    )
    got = as_dicts(
        ja.current_job_steps(listing, jobs, rows("job_steps", *STEPS), history, activity),
        "job_id", "instance_id",
    )
    assert [(g["step_name"], g["run_status"], g["run_status_desc"]) for g in got] == [
        ("Step 1. copy", 0, "broke"),
        ("Step 2. check", 3, "Unknown status"),
        ("Step 1. copy", 2, "In Progress"),
        ("Step 2. check", 4, "Unknown"),
        ("Step 1. load", 4, "Unknown status"),
    ]
    assert got[3]["step_duration"] == "03:45:59"
    assert got[4]["step_duration"] is None


def test_equal_rows_collapse_in_the_union(spark, rows):
    listing, jobs = rows("job_listing", (1, 0, 1, 4)), rows("jobs", (1, "a", 1))
    history = rows("job_history", hist(1, 1, 1, 2, 100000), hist(2, 1, 1, 2, 100000))
    got = fleet_status(
        listing, jobs, rows("job_servers", (1, 1)), rows("job_steps", (1, 1, "copy")), history,
        rows("job_activity", (1, at(9), None)), NOW,
    )
    assert sorted(r.level for r in got.collect()) == ["Job-Level", "Step-Level"]


def test_one_job_with_most_of_the_history(spark, rows):
    """Against brute force, without broadcast joins."""
    history = [hist(i, 1 if i % 3 else i % 5 + 2, i % 4, i % 5, 90000 + i % 60) for i in range(3000)]
    steps = [(job, step, "s") for job in range(1, 9) for step in (1, 2, 3)]
    starts = {1: at(9, 0, 10), 2: at(9, 0, 31), 3: at(8)}
    activity = [(job, start, None) for job, start in starts.items()]
    rounded = {1: at(9), 2: at(9, 1), 3: at(8)}
    expected = []
    for job, step, _ in steps:
        ids = [
            h[0] for h in history
            if h[1] == job and h[2] == step and job in rounded
            and at(h[5] // 10000, h[5] // 100 % 100, h[5] % 100) >= rounded[job]
        ]
        expected += [(job, step, i) for i in ids] or [(job, step, None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ja.job_step_outer(
            rows("job_steps", *steps), rows("job_history", *history), rows("job_activity", *activity)
        ).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    key = lambda t: (t[0], t[1], -1 if t[2] is None else t[2])
    assert sorted([(r.job_id, r.step_id, r.instance_id) for r in got], key=key) == sorted(expected, key=key)


def test_equal_job_ids_on_two_servers(spark, rows):
    both = ("A", "B")
    jobs = rows("jobs", *[(1, f"job {s}", 1, s) for s in both])
    listing = rows("job_listing", *[(1, 0, 0, 4, s) for s in both])
    servers = rows("job_servers", (1, 0, "A"), (1, 1, "B"))
    activity = rows("job_activity", (1, at(9), at(10), "A"), (1, at(11), at(12), "B"))
    status = as_dicts(ja.current_jobs_status(listing, jobs, servers, activity, NOW), "server")
    assert [(s["job_name"], s["run_status_desc"], s["job_start"]) for s in status] == [
        ("job A", "Failed", at(9)), ("job B", "Success", at(11)),
    ]
    steps = rows("job_steps", *[(1, 1, "copy", s) for s in both])
    history = rows("job_history", (*hist(1, 1, 1, 1, 100000)[:-1], "A"), (*hist(2, 1, 1, 1, 100000)[:-1], "B"))
    ran = as_dicts(ja.current_job_steps(listing, jobs, steps, history, activity), "server")
    assert [(r["server"], r["instance_id"]) for r in ran] == [("A", 1), ("B", None)]


def test_history_before_the_oldest_start_is_not_scanned(spark, rows, tmp_path):
    old, new = hist(1, 1, 1, 1, 100000, day=20240101), hist(2, 1, 1, 1, 100000)
    rows("job_history", old, new).write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    got = ja.job_step_outer(rows("job_steps", *STEPS), history, rows("job_activity", (1, at(9), None)))
    assert "isnotnull(run_date" in plan_of(got) and "run_date" in plan_of(got).split("DataFilters")[1]
    assert sorted((r.job_id, r.step_id, r.instance_id or 0) for r in got.collect()) == [(1, 1, 2), (1, 2, 0), (2, 1, 0)]
    nothing = ja.job_step_outer(rows("job_steps", *STEPS), history, rows("job_activity"))
    assert [r.instance_id for r in nothing.collect()] == [None] * 3
