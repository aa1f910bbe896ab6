"""Joins on a key that holds most rows are split by adaptive execution."""

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import functions as F

from fleetscope.operators import job_activity, job_failures, registry
from fleetscope.operators.spread import spread_lookup
from fleetscope.sinks import tables

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


@contextmanager
def settings(spark, values):
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_history(spark, n=60_000):
    """A third of the rows on job 7, in several map tasks."""
    return spark.range(0, n, 1, 16).select(
        F.col("id").alias("instance_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("job_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 3 + 1).cast("int")).alias("step_id"),
        (F.col("id") % 5).cast("int").alias("run_status"),
        F.lit(20240115).alias("run_date"),
        F.lit(120000).alias("run_time"),
        F.lit(10).alias("run_duration"),
        F.lit(0).alias("sql_message_id"),
        F.lit(0).alias("sql_severity"),
        F.sha2(F.col("id").cast("string"), 512).alias("message"),
        F.lit("S").alias("server"),
    )


def dimensions(spark):
    jobs = spark.range(900).select(F.col("id").alias("job_id"), F.lit("j").alias("name"), F.lit("S").alias("server"))
    numbers = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    steps = jobs.select("server", "job_id", numbers.alias("step_id"), F.lit("s").alias("step_name"))
    return jobs, steps


def test_hot_job_in_the_failure_view(spark):
    with settings(spark, SMALL):
        view = job_failures.failed_jobs_view(
            hot_history(spark), *dimensions(spark), dt.date(2024, 1, 15)
        )
        assert "skew=true" in final_plan(view)
        assert view.count() == 48_000


def test_hot_job_in_the_step_status(spark):
    jobs, steps = dimensions(spark)
    activity = jobs.select(
        "server",
        "job_id",
        F.lit("2024-01-15 09:00:00").cast("timestamp_ntz").alias("start"),
        F.lit(None).cast("timestamp_ntz").alias("stop"),
    )
    with settings(spark, SMALL):
        result = job_activity.job_step_outer(steps, hot_history(spark), activity)
        assert "skew=true" in final_plan(result)
        found = result.agg(F.count("instance_id"), F.count(F.lit(1))).first()
        ran = hot_history(spark).select("job_id", "step_id").distinct().count()
        assert tuple(found) == (60_000, 60_000 + 2700 - ran)


def test_hot_script_among_the_offered(spark):
    """The names applied are aggregated on the join key; the look-up still splits."""
    offered = spark.range(0, 60_000, 1, 16).select(
        F.col("id").alias("list_id"),
        F.concat(
            F.sha2(F.lit("s"), 512),
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).cast("string"),
        ).alias("script_name"),
        F.sha2(F.col("id").cast("string"), 512).alias("full_file_name"),
    )
    applied = offered.filter("list_id < 900 and list_id % 2 = 0").select(
        "script_name", F.lit(False).alias("is_error")
    )
    with settings(spark, SMALL):
        pending = registry.release_pending(offered, applied)
        names = {r[0] for r in applied.select("script_name").distinct().collect()}
        expected = sum(r.script_name not in names for r in offered.select("script_name").collect())
        assert pending.count() == expected


def test_spread_lookup_equals_the_plain_join(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 40).alias("k")
    )
    keyed = spark.range(0, 40, 3).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    rows = rows.unionByName(spark.range(900).select(F.col("id").alias("n"), F.lit(None).cast("long").alias("k")))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = rows.join(keyed, ["k"], how)
        for pieces in (1, 5, 1000):
            spread = spread_lookup(rows, keyed, ["k"], "n", how, pieces).select(*plain.columns)
            assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    assert spread_lookup(rows.limit(0), keyed, ["k"], "n", "left").isEmpty()


def test_only_hot_keys_are_repeated(spark):
    """One key with half of 20,000 rows: it is repeated, the 10,000 others are not."""
    rows = spark.range(20_000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    keyed = rows.groupBy("k").agg(F.count("*").alias("v"))
    with settings(spark, {**SMALL, "spark.sql.adaptive.enabled": "false"}):
        joined = spread_lookup(rows, keyed, ["k"], "n")
        assert joined.count() == 20_000
        assert joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 4_500


def test_hot_day_is_split_when_written(spark, tmp_path):
    days = hot_history(spark).withColumn("day", F.when(F.col("job_id") == 7, "a").otherwise("b"))
    with settings(spark, {**SMALL, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k"}):
        tables.append_rows(days, str(tmp_path / "t"), ["day"])
    files = list((tmp_path / "t" / "day=b").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000
