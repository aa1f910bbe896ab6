"""Numbering and paging against brute force, with one group holding most rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fleetscope.operators import keys, paging
from tests.conftest import plan_of


def brute_numbers(pairs):
    result = {}
    for group in {g for g, _ in pairs}:
        for position, key in enumerate(sorted(k for g, k in pairs if g == group), start=1):
            result[(group, key)] = position
    return result


@pytest.mark.parametrize("spread", [1, 50_000, 3 * 10**12])
def test_positions_match_brute_force(spark, spread):
    """Dense, sparse and very sparse keys: one, many blocks and many super blocks."""
    dice = random.Random(spread)
    ids = dice.sample(range(3000), 2000)
    pairs = [("hot" if i % 3 else f"g{i % 7}", i * spread) for i in ids] + [(None, 5), (None, 9)]
    df = spark.createDataFrame(pairs, "g string, k long").repartition(7)
    got = {
        (r.g, r.k): r.row_no for r in keys.number_rows(df, "k", by=["g"]).collect()
    }
    assert got == brute_numbers(pairs)


def test_negative_keys_come_first(spark):
    df = spark.createDataFrame([(k,) for k in (-70000, -1, 0, 3, 2**62)], "k long")
    got = keys.number_rows(df, "k").orderBy("k").collect()
    assert [r.row_no for r in got] == [1, 2, 3, 4, 5]


def test_keys_follow_the_existing_maximum(spark):
    df = spark.range(200_000, 300_000).withColumnRenamed("id", "source")
    existing = spark.createDataFrame([(41,), (7,)], "key long")
    keyed = keys.assign_keys(df, "source", "key", existing)
    low, high, count = keyed.agg(F.min("key"), F.max("key"), F.countDistinct("key")).first()
    assert (low, high, count) == (42, 100_041, 100_000)
    assert keyed.filter(F.col("key") - 42 != F.col("source") - 200_000).count() == 0


def test_keys_start_at_first_without_rows(spark):
    df = spark.range(3).withColumnRenamed("id", "source")
    empty = spark.createDataFrame([], "key long")
    keyed = keys.assign_keys(df, "source", "key", empty, first=1000).orderBy("source")
    assert [r["key"] for r in keyed.collect()] == [1000, 1001, 1002]
    assert [r["key"] for r in keys.assign_keys(df, "source", "key").orderBy("source").collect()] == [1, 2, 3]


def test_no_window_sees_a_whole_group(spark):
    """The data window is partitioned by block, not by group alone."""
    df = spark.range(10).select("id", (F.col("id") % 2).cast("string").alias("g"))
    plan = plan_of(keys.number_rows(df, "id", by=["g"]))
    groups = re.findall(r"Window \[sum\(_add#\d+L?\).*?\], \[(.*?)\], \[", plan)
    names = [re.sub(r"#\d+L?", "", group) for group in groups]
    assert names == ["g, _block", "g, _above", "g, _above", "g"]
    assert "Join" not in plan


def test_dense_wide_rows_spread_over_tasks(spark):
    """65,536 rows with text and consecutive ids are numbered in many tasks."""
    wide = spark.range(0, 65_536, 1, 8).withColumn("text", F.repeat(F.lit("x"), 1000))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        keyed = keys.assign_keys(wide, "id", "key").withColumn("part", F.spark_partition_id())
        spread = keyed.groupBy("part").agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(spread) >= 6 and max(r.n for r in spread) < 20_000


def test_sort_position_orders_text_and_survives_a_second_read(spark):
    names = [f"n{i % 900:04d}" for i in range(3000)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i long")
    placed = keys.sort_position(df.repartition(5), "name", "i")
    first = placed.orderBy("position").collect()
    assert [(r.name, r.i) for r in first] == sorted((n, i) for i, n in enumerate(names))
    assert first == placed.orderBy("position").collect()


def test_pages_join_to_the_whole_text(spark):
    values = [("hot", i, f"<{i}>") for i in range(0, 5000, 2)] + [("cold", 1, "<a>"), ("cold", 9, None)]
    df = spark.createDataFrame(values, "g string, k long, t string").repartition(6)
    pages = paging.paged_text(df, F.coalesce("t", F.lit("?")), "k", ["g"], "", page_rows=100)
    got = pages.orderBy("g", "page").collect()
    assert max(r.n_rows for r in got) == 100
    assert "".join(r.body for r in got if r.g == "hot") == "".join(f"<{i}>" for i in range(0, 5000, 2))
    assert [r.body for r in got if r.g == "cold"] == ["<a>?"]
    assert [r.page for r in got if r.g == "hot"] == list(range(1, 26))


def in_place(spark, df, **limits):
    keyed = keys.number_in_place(df, "k", name="n", **limits)
    return keyed, [r.n for r in keyed.orderBy("k").collect()]


@pytest.mark.parametrize("layout", ["ordered", "ranges", "late", "interleaved", "one", "empty"])
def test_numbers_in_place_match_the_order(spark, layout):
    """Files one after the other, in any order, with late rows between, or with all keys mixed."""
    df = spark.range(0, 6000, 3, 5).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 100).alias("text"))
    if layout == "ranges":
        df = df.select(((F.col("k") * 7) % 6000 - 3000).alias("k"), "text").repartitionByRange(6, F.desc("k"))
    if layout == "late":
        df = df.unionByName(spark.createDataFrame([(k, "late") for k in (-5, 1000, 1001, 5999, 9000)], "k long, text string"))
    if layout == "interleaved":
        df = df.repartition(7)
    if layout == "one":
        df = df.limit(1)
    if layout == "empty":
        df = df.limit(0)
    keyed, numbers = in_place(spark, df)
    assert numbers == list(range(1, df.count() + 1))
    assert sorted(keyed.drop("n").collect()) == sorted(df.collect())
    # The runs of each file are put together; no other exchange is left when rows are numbered.
    exchanges = re.findall(r"(?<!Broadcast)(?<!Reused)Exchange \w+\(?\w*", plan_of(keyed))
    assert (set(exchanges) <= {"Exchange hashpartitioning(_file"}) == (layout != "interleaved")


def test_many_runs_are_numbered_by_blocks(spark):
    df = spark.range(0, 2000, 1, 4).select(F.col("id").alias("k")).repartition(4)
    for limits in ({"max_runs": 3}, {"max_file_runs": 1}):
        keyed, numbers = in_place(spark, df, **limits)
        assert numbers == list(range(1, 2001)) and "Window" in plan_of(keyed)


def test_wide_keys_follow_the_existing_maximum(spark):
    df = spark.range(10, 0, -1, 3).select(F.col("id").alias("k"))
    existing = spark.createDataFrame([(41,)], "key long")
    for given, first in ((existing, 42), (existing.limit(0), 1), (None, 1)):
        keyed = keys.assign_keys(df, "k", "key", given, wide=True).orderBy("k")
        assert [r["key"] for r in keyed.collect()] == list(range(first, first + 10))
