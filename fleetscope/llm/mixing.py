"""Mixing sources to target weights by weighted fair queueing.

The documents of a source queue up in hashed order, ``max_repeats`` times one
after the other. A queued document's virtual finish time is the number of words
queued up to and with it, divided by its source's weight. All queues are served
together in the order of the finish times until the budget is used up, so a
source with a small weight or few words never holds up the others, and a source
whose queue is empty leaves its share to the rest by weight.

Running sums are taken over hashed blocks of a source (first over the sums of
blocks, then inside each block) and over range-sorted parts (first over the sums
of parts), so no source and no stretch of the order has to fit one task.

A null text has size 0 and is never taken. A null source is a source of its own,
after all others. Rows of one doc_id in one source queue behind each other; a
null doc_id queues first. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.session import cut_lineage

WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MAX_REPEATS = 2
#: Rows of a block of a source, about.
BLOCK_ROWS = 4096


def word_count(text: Column) -> Column:
    """Runs of characters other than blank, tab, line feed, vertical tab, form feed and return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], budget_share: float, max_repeats: int) -> DataFrame:
    """Per source its weight and target; ``sizes`` has source and source_size.

    The weights go round the sources by code point, null last. Shares beyond ``max_repeats`` times a
    source's size are shared out again by weight until none is; only sums come to the driver.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), place % len(weights) + 1)
    known = cut_lineage(sizes.withColumn("weight", weight.cast("long")))
    limit = F.col("source_size") * max_repeats
    total = known.agg(F.sum("source_size")).first()[0] or 0
    budget, level, full = budget_share * total, 0.0, -1
    while True:
        share = F.lit(level) * F.col("weight")
        capped = (limit <= share) if full >= 0 else F.lit(False)
        row = known.agg(
            F.sum(F.when(capped, limit)).alias("used"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
            F.count(F.when(capped, 1)).alias("full"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        full, level = row["full"], (budget - (row["used"] or 0)) / row["open"]
    target = F.least(limit.cast("double"), F.lit(level) * F.col("weight"))
    return known.withColumn("target", target)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget_share: float = BUDGET_SHARE,
    max_repeats: int = MAX_REPEATS,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per document doc_id, size, source_size, target, repeats and taken (words, repeats counted).

    ``carry`` names further columns that come with them.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), *carry
    ).withColumn("_hash", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = cut_lineage(rows)
    n = rows.count()
    digits = 1
    while 16**digits * BLOCK_ROWS < n:
        digits += 1
    rows = rows.withColumn("_block", F.substring("_hash", 1, digits))
    blocks = rows.groupBy("source", "_block").agg(F.sum("size").alias("_sum"))
    known = targets(blocks.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, budget_share, max_repeats)
    ahead = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    marks = blocks.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum")
    marks = marks.join(known, marks["source"].eqNullSafe(known["source"])).drop(known["source"])
    m = marks.withColumnsRenamed({"source": "_s", "_block": "_b"})
    rows = rows.join(m, rows["source"].eqNullSafe(m["_s"]) & (rows["_block"] == m["_b"])).drop("_s", "_b")
    inside = (
        Window.partitionBy("source", "_block").orderBy("_hash", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = cut_lineage(rows.withColumn("_end", F.col("_ahead") + F.sum("size").over(inside)))

    def finish(turn: int | Column) -> Column:
        return (F.col("_end") + turn * F.col("source_size")).cast("double") / F.col("weight")

    turn = F.explode(F.array(*[F.lit(i) for i in range(max_repeats)])).alias("turn")
    queue = rows.filter("size > 0").select("doc_id", "source", "size", "_end", "source_size", "weight", turn)
    queue = queue.withColumn("finish", finish(F.col("turn"))).select("finish", "source", "doc_id", "turn", "size")
    order = ["finish", F.col("source").asc_nulls_last(), "doc_id", "turn"]
    served = queue.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    served = cut_lineage(served.sortWithinPartitions(*order))
    parts = served.groupBy("_part").agg(F.sum("size").alias("_sum"))
    parts = parts.withColumn("_to", F.sum("_sum").over(Window.orderBy("_part")))
    total = known.agg(F.sum("source_size")).first()[0] or 0
    budget = budget_share * total
    reached = parts.filter(F.col("_to") >= budget).orderBy("_to").limit(1).first()
    last = None
    if reached:
        running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        edge = served.filter(F.col("_part") == reached["_part"])
        edge = edge.withColumn("_at", F.lit(reached["_to"] - reached["_sum"]) + F.sum("size").over(running))
        last = edge.filter(F.col("_at") <= budget).agg(F.max("finish")).first()[0]
        if last is None:
            last = served.filter(F.col("_part") < reached["_part"]).agg(F.max("finish")).first()[0]
        last = -1.0 if last is None else last
    repeats = F.lit(0)
    for i in range(max_repeats):
        repeats = repeats + ((finish(i) <= last) if reached else F.lit(True)).cast("int")
    repeats = F.when(F.col("size") > 0, repeats).otherwise(0)
    return rows.select(
        "doc_id", "size", "source_size", F.col("target"), repeats.alias("repeats"),
        (F.col("size") * repeats).alias("taken"), *carry,
    )
