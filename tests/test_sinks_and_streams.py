import datetime as dt
import time
from pathlib import Path

from pyspark.sql import functions as F

from fleetscope import session
from fleetscope.operators import backups
from fleetscope.plans import failure_poll
from fleetscope.schemas import DDL, table_schema
from fleetscope.session import fresh_folder
from fleetscope.sinks import tables
from fleetscope.streaming import feeds

NOW = dt.datetime(2024, 1, 15, 13, 30)
DAY = dt.date(2024, 1, 15)


def test_versions_show_committed_states_only(spark, rows, tmp_path):
    location = str(tmp_path / "jobs")
    assert tables.current_version(spark, location, "jobs").isEmpty()
    assert tables.publish_version(rows("jobs", (1, "a", 1)), location) == 1
    state = tables.current_version(spark, location, "jobs")
    assert tables.publish_version(state.withColumn("enabled", F.lit(0)), location) == 2
    assert tables.current_version(spark, location, "jobs").first()["enabled"] == 0
    # a write that did not commit is not read, and its number is used again
    rows("jobs", (9, "z", 1)).write.parquet(location + "/version=3")
    (tmp_path / "jobs" / "version=3" / "_SUCCESS").unlink()
    assert tables.current_version(spark, location, "jobs").first()["job_id"] == 1
    assert tables.publish_version(rows("jobs", (5, "q", 1)), location) == 3
    assert [r.job_id for r in tables.current_version(spark, location, "jobs").collect()] == [5]


def test_only_touched_partitions_are_replaced(spark, rows, tmp_path):
    location = str(tmp_path / "t")
    ddl = "k int, v string, d string"
    tables.append_rows(rows(ddl, (1, "a", "x"), (2, "b", "y")), location, ["d"])
    tables.append_rows(rows(ddl, (3, "c", "y")), location, ["d"])
    tables.replace_partitions(rows(ddl, (2, "B", "y")), location, ["d"])
    got = spark.read.schema(ddl).parquet(location)
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (2, "B")]


def test_state_change_rewrites_touched_days_only(spark, rows, tmp_path):
    """The operator runs on the touched part and the result equals the whole change."""
    location, ddl = str(tmp_path / "h"), f"{DDL['backup_history']}, create_day date"
    table = [
        (i, i, "j", True, False, None, NOW, NOW, NOW, "S", dt.date(2024, 1, 1 + i % 5)) for i in range(50)
    ]
    tables.append_rows(rows(ddl, *table), location, ["create_day"])
    stored = spark.read.schema(ddl).parquet(location)
    failures = rows(
        "server string, set_id bigint, message string", ("S", 3, "x"), ("S", 8, "y"), ("S", 14, "z")
    )
    expected = sorted(map(tuple, backups.backup_fail(stored, failures, NOW).collect()), key=repr)
    untouched = [f for f in stored.inputFiles() if "2024-01-04" not in f and "2024-01-05" not in f]
    part = tables.touched_partitions(stored, failures, backups.SET, "create_day")
    assert part.count() == 20
    tables.replace_partitions(backups.backup_fail(part, failures, NOW), location, ["create_day"])
    after = spark.read.schema(ddl).parquet(location)
    assert sorted(map(tuple, after.select(*stored.columns).collect()), key=repr) == expected
    assert set(untouched) <= set(after.inputFiles())


def test_shuffle_partitions_follow_the_data():
    small = session.shuffle_settings(10**6, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    large = session.shuffle_settings(10 * 2**40, cores=4000)
    assert int(large["spark.sql.shuffle.partitions"]) == 10 * 2**40 // (128 * 2**20)


def test_working_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.working_folder(spark) == configured.rstrip("/")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_cut_lineage_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    cut = session.cut_lineage(spark.range(1000).mapInPandas(count, "id long"))
    assert cut.count() == 1000 and cut.agg(F.sum("id")).first()[0] == 499_500
    assert seen.value == 1000


def test_a_cut_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {b.name() for b in _each(disk.getAllBlocks()) if b.isShuffle() or "shuffle" in b.name()}
    before = shuffles()
    cut = session.cut_lineage(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    for _ in range(50):  # Spark deletes them in the background
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and cut.count() == 100
    assert spark.conf.get(session.CLEANUP) == "false"


def _each(sequence):
    return [sequence.apply(i) for i in range(sequence.size())]


def test_cuts_are_deleted_on_request(spark):
    cut = session.cut_lineage(spark.range(10))
    folder = cut.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    assert session.drop_cuts(spark) >= 1 and not Path(folder).exists()
    assert session.drop_cuts(spark) == 0


def history_row(instance, status=0):
    return (instance, 1, 1, status, 20240115, 905, 10, 0, 0, "m", "S")


def test_failed_job_feed_adds_each_failure_once(spark, rows, tmp_path):
    source, location, state = str(tmp_path / "in"), fresh_folder(spark, "rec"), fresh_folder(spark, "st")
    jobs, steps = rows("jobs", (1, "load", 1)), rows("job_steps", (1, 1, "copy"))

    def run(state_folder):
        feed = feeds.file_feed(spark, source, table_schema("job_history"), files_per_batch=1)
        feeds.record_failed_jobs(feed, jobs, steps, location, state_folder, NOW)
        found = failure_poll.recorded_failures(spark, location)
        return sorted(r.instance_id for r in found.collect())

    history = lambda *values: rows("job_history", *values).coalesce(1)
    history(history_row(1), history_row(1), history_row(2, 1)).write.mode("append").parquet(source)
    history(history_row(1), history_row(3)).write.mode("append").parquet(source)
    assert run(state) == [1, 3]
    assert run(state) == [1, 3]
    history(history_row(3), history_row(4)).write.mode("append").parquet(source)
    assert run(state) == [1, 3, 4]
    # rows of another day come late and are kept
    late = (7, 1, 1, 0, 20240113, 905, 10, 0, 0, "m", "S")
    history(late, history_row(4)).write.mode("append").parquet(source)
    assert run(state) == [1, 3, 4, 7]
    # so are rows without a time
    undated = (8, 1, 1, 0, 0, 905, 10, 0, 0, "m", "S")
    history(undated).write.mode("append").parquet(source)
    assert run(state) == [1, 3, 4, 7, 8]
    # a feed that starts over sees everything again and adds nothing
    assert run(fresh_folder(spark, "st")) == [1, 3, 4, 7, 8]


def test_blocked_feed_keys_follow_over_batches(spark, rows, tmp_path):
    source = str(tmp_path / "in")
    events_at, details_at = fresh_folder(spark, "e"), fresh_folder(spark, "d")
    state = fresh_folder(spark, "s")
    databases = rows("databases", (5, "sales", 1, False, False))

    def report(spid):
        side = f'<process spid="{spid}" currentdb="5"/>'
        return (
            "<TextData><blocked-process-report><blocked-process><process/></blocked-process>"
            f"<blocking-process>{side}</blocking-process></blocked-process-report></TextData>"
        )

    def run():
        feed = feeds.file_feed(spark, source, table_schema("blocked_reports"), files_per_batch=1)
        feeds.record_blocked_events(feed, databases, events_at, details_at, state)
        stored = spark.read.parquet(events_at).orderBy("blocked_events_id").collect()
        return [(r.blocked_events_id, r.spid) for r in stored]

    for ids in ((1, 2), (3,)):
        frame = rows("blocked_reports", *[(i, NOW, report(50 + i)) for i in ids])
        frame.coalesce(1).write.mode("append").parquet(source)
        first = run()
    assert first == [(1, 51), (2, 52), (3, 53)]
    assert run() == first
    details = spark.read.parquet(details_at)
    assert details.count() == 6 and details.filter("currentdb = 'sales'").count() == 3


def test_deadlock_feed(spark, rows, tmp_path):
    source = str(tmp_path / "in")
    events_at, texts_at = fresh_folder(spark, "e"), fresh_folder(spark, "t")
    rows("deadlock_docs", (4, "a&#x20;b"), (2, "c")).write.parquet(source)
    feed = feeds.file_feed(spark, source, table_schema("deadlock_docs"))
    feeds.record_deadlock_events(feed, events_at, texts_at, fresh_folder(spark, "s"), NOW)
    stored = spark.read.parquet(events_at).orderBy("doc_id").collect()
    assert [(r.deadlock_events_id, r.doc_id) for r in stored] == [(1, 2), (2, 4)]
    texts = spark.read.parquet(texts_at).orderBy("doc_id").collect()
    assert texts[1].body.endswith("ab")
