import datetime as dt

from pyspark.sql import functions as F

from fleetscope.operators import job_failures as jf
from fleetscope.plans import failure_poll
from fleetscope.session import fresh_folder
from fleetscope.sinks import tables
from tests.conftest import as_dicts, plan_of
from workload import fixtures as fx

DAY = dt.date(2024, 1, 15)
NOW = dt.datetime(2024, 1, 15, 13, 30)


def history_row(instance, status=0, step=1, day=20240115, server="S1", message="m", job=1):
    return (instance, job, step, status, day, 905, 10, 0, 0, message, server)


def inputs(rows, *history):
    return (
        rows("job_history", *history),
        rows("jobs", (1, "load", 1, "S1"), (1, "load", 1, "S2")),
        rows(
            "job_steps",
            *[(1, n, name, s) for s in ("S1", "S2") for n, name in ((1, "copy"), (2, "check"))],
        ),
    )


def test_view_keeps_only_failures_of_the_day_with_a_step(spark, rows):
    view = jf.failed_jobs_view(
        *inputs(
            rows,
            history_row(1),
            history_row(2, status=1),
            history_row(3, step=0),
            history_row(4, day=20240114),
            history_row(5, status=7),
            history_row(6, job=99),
        ),
        DAY,
    )
    got = as_dicts(view, "instance_id")
    assert [g["instance_id"] for g in got] == [1, 5]
    assert got[0]["run_status"] == "Failed" and got[1]["run_status"] is None
    assert got[0]["exec_date"] == dt.datetime(2024, 1, 15, 0, 9, 5)
    assert got[0]["step_name"] == "copy"


def test_ids_are_compared_per_server(spark, rows):
    view = jf.failed_jobs_view(*inputs(rows, history_row(1), history_row(1, server="S2")), DAY)
    recorded = jf.loaded_rows(view.filter("server = 'S1'"), NOW)
    new = jf.failed_jobs_new(view, recorded)
    assert [r.server for r in new.collect()] == ["S2"]
    after = jf.failed_jobs_append(new, recorded, NOW)
    assert jf.failed_jobs_new(view, after).isEmpty()
    assert jf.new_row_guard(new).collect()[0].asDict() == {"server": "S2", "new_rows": 1}


def test_report_pages_are_ordered_and_escaped(spark, rows):
    view = jf.failed_jobs_view(
        *inputs(rows, *[history_row(i, message=f"<{i}>") for i in (30, 4, 200)], history_row(5, message=None)),
        DAY,
    )
    pages = as_dicts(jf.failed_jobs_report(view, NOW, page_rows=3), "page")
    assert [p["n_rows"] for p in pages] == [3, 1]
    body = pages[0]["body"]
    assert body.index("&lt;4&gt;") < body.index("<td></td>") < body.index("&lt;30&gt;")
    assert "&lt;200&gt;" in pages[1]["body"] and body.endswith("</table></body></html>")


def test_report_lines_make_the_page(spark, rows):
    view = jf.failed_jobs_view(*inputs(rows, *[history_row(i) for i in range(1, 1500)]), DAY)
    lines = jf.failed_jobs_report(view, NOW).orderBy("server", "section", "position").collect()
    page = jf.failed_jobs_report(view, NOW, page_rows=2000).collect()
    assert len(lines) == 1501 and "".join(r.line for r in lines) == page[0].body


def test_poll_records_before_it_reports_and_only_once(spark, rows):
    location = fresh_folder(spark, "poll")
    emails = rows("alert_emails", (1, "a", "A@Example.com", True))
    history, jobs, steps = inputs(rows, history_row(1), history_row(2))
    first = failure_poll.poll(history, jobs, steps, emails, location, DAY, NOW)
    assert first.new.count() == 2
    assert [r.section for r in first.report.orderBy("section", "position").collect()] == [1, 2, 2, 3]
    assert first.recipients.first()["recipient"] == "a@example.com"
    assert failure_poll.recorded_failures(spark, location).count() == 2
    assert failure_poll.poll(history, jobs, steps, emails, location, DAY, NOW) is None
    history = rows("job_history", history_row(1), history_row(2), history_row(3))
    again = failure_poll.poll(history, jobs, steps, emails, location, DAY, NOW)
    assert [r.instance_id for r in again.new.collect()] == [3]
    assert failure_poll.recorded_failures(spark, location).count() == 3


def test_day_reaches_a_stored_history_as_a_pushed_filter(spark, rows, tmp_path):
    history, jobs, steps = inputs(rows, history_row(1))
    history.write.parquet(str(tmp_path / "history"))
    stored = tables.open_table(spark, str(tmp_path / "history"), "job_history")
    plan = plan_of(jf.failed_jobs_view(stored, jobs, steps, DAY))
    assert "EqualTo(run_date,20240115)" in plan
    assert "retries" not in plan


def test_record_reads_one_day_partition(spark, rows):
    location = fresh_folder(spark, "record")
    view = jf.failed_jobs_view(*inputs(rows, history_row(1)), DAY)
    failure_poll.record_failures(view, location, NOW)
    day = failure_poll.recorded_failures(spark, location, [DAY])
    assert day.columns == failure_poll.recorded_failures(spark, location).columns
    assert day.count() == 1 and all("exec_day=2024-01-15" in f for f in day.inputFiles())
    assert failure_poll.recorded_failures(spark, location, [dt.date(2024, 1, 16)]).isEmpty()


def test_flagship_bounds_reach_the_scan(spark, sf_dir):
    view = jf.failed_jobs_view(
        fx.day_history(spark, sf_dir), fx.jobs(spark, sf_dir), fx.job_steps(spark, sf_dir), DAY
    )
    plan = plan_of(view)
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan
    assert "LessThan(ts,2024-01-16T00:00)" in plan


def test_most_rows_on_one_job_without_broadcast(spark):
    """One job holds nearly all failures; shuffle joins give every row."""
    history = spark.range(20_000).select(
        F.col("id").alias("instance_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(1).alias("job_id"),
        F.lit(1).alias("step_id"),
        F.lit(0).alias("run_status"),
        F.lit(20240115).alias("run_date"),
        F.lit(905).alias("run_time"),
        F.lit(0).alias("run_duration"),
        F.lit(0).alias("sql_message_id"),
        F.lit(0).alias("sql_severity"),
        F.lit("m").alias("message"),
        F.lit("S").alias("server"),
    )
    on_server = spark.range(50).select(F.col("id").alias("job_id"), F.lit("S").alias("server"))
    jobs = on_server.withColumn("name", F.lit("j"))
    steps = on_server.withColumns({"step_id": F.lit(1), "step_name": F.lit("s")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = jf.failed_jobs_view(history, jobs, steps, DAY)
        assert view.count() == 20_000
        assert view.select("instance_id").distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
