"""Connected components, and exact comparison inside them by blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import release
from fleetscope.session import cut_lineage

#: Members of a block; components up to this size are compared in one go.
BLOCK = 256


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reached) of every end of the edges (a, b).

    Each round takes the smallest label among a node's neighbours and then that label's own label, so
    distances halve. A round is two joins and an aggregation, written to the shared folder.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.filter(F.col("a") != F.col("b")).distinct())
    labels = cut_lineage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("_label")), "b")
        near = near.groupBy("a").agg(F.min("_label").alias("_near"))
        lower = labels.join(near, "a").select("a", "label", F.least("label", "_near").alias("_low"))
        above = labels.select(F.col("a").alias("_low"), F.col("label").alias("_up"))
        lower = lower.join(above, "_low").select("a", F.least("_low", "_up").alias("label"), F.col("label").alias("_was"))
        lower = cut_lineage(lower)
        moved = lower.filter(F.col("label") != F.col("_was")).limit(1).count()
        labels = lower.select("a", "label")
        if not moved:
            return labels.select(F.col("a").alias("id"), F.col("label").alias("component"))


def compare_members(
    members: DataFrame, linked: Callable, payload: list[str], rows_per_task: int = 1500
) -> DataFrame:
    """Links between the members of each component, every pair compared once.

    ``members`` has node (long, unique), component, weight and the payload columns. ``linked`` takes a
    table of payloads and returns the symmetric matrix of links between its rows. A component of more
    than BLOCK members is cut into blocks by a hash, and a task compares two of its blocks, so a pair's
    task stays small whatever the component's size. Returned per node and task: node, links (weights of
    its links) and root (a node that the task's links connect it with); never a row per pair.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("_n"))
    packs = max(1, members.count() // rows_per_task)
    rows = members.join(sizes, "component").withColumn("_blocks", F.ceil(F.col("_n") / BLOCK).cast("int"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    alone = F.col("_blocks") == 1
    rows = rows.select(
        "component", "node", "weight", *payload, F.col("_block"),
        F.when(alone, F.pmod(F.xxhash64("component"), F.lit(packs))).otherwise(F.col("component")).alias("_pack"),
        F.when(alone, -1).otherwise(F.least("_block", "_other")).alias("_i"),
        F.when(alone, -1).otherwise(F.greatest("_block", "_other")).alias("_j"),
    )
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(key, table):
        nodes, weights = table.column("node").to_numpy(), table.column("weight").to_numpy()
        component, block = table.column("component").to_numpy(), table.column("_block").to_numpy()
        order = np.argsort(component, kind="stable")
        cuts = np.flatnonzero(np.diff(component[order], prepend=component[order[0]] - 1 if len(order) else 0))
        links, roots = np.zeros(len(nodes), np.int64), nodes.copy()
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            some = order[a:b]
            if len(some) < 2:
                continue
            match = linked(table.take(pa.array(some)).select(payload))
            if key[1].as_py() != key[2].as_py():
                match &= block[some][:, None] != block[some]
            np.fill_diagonal(match, False)
            links[some] = match @ weights[some]
            # Labels run along the links until none changes.
            label = np.arange(len(some))
            while True:
                low = np.minimum(label, np.where(match, label[None, :], len(some)).min(1))
                low = low[low]
                if (low == label).all():
                    break
                label = low
            roots[some] = nodes[some][label]
        release()
        return pa.Table.from_arrays([pa.array(nodes), pa.array(links), pa.array(roots)], schema=schema)

    return rows.groupBy("_pack", "_i", "_j").applyInArrow(run, "node long, links long, root long")
