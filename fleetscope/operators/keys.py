"""Consecutive numbers for distributed rows.

A plain ``row_number()`` over one ordering sends every row of a group to one
task. Here the integer order key is cut into fixed blocks: the blocks are
counted with map-side combine, running totals over the counts give each block
its offset, and the numbering runs inside a block only. With unique 63-bit keys
no window ever holds more than 2**10 data rows, so that wide rows spread too,
or 2**21 counts, whatever the size of the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.session import cut_lineage

# Runs that the numbering in place may broadcast, and that one file may have.
MAX_RUNS = 1 << 18
MAX_FILE_RUNS = 256

# Bits of the order key that a block leaves out, and of a block that each level above it leaves out.
BLOCK_BITS = 10
LEVEL_BITS = (16, 16)


def _running_total(
    rows: DataFrame, marks: DataFrame, group: Sequence[str], order: str
) -> DataFrame:
    """Add ``_total``: the sum of ``_add`` up to each row of its group.

    ``marks`` has at most one row per group, whose ``_add`` the group starts
    with. It enters the window as the first row instead of a join, so the rows
    are shuffled and sorted once, and a NULL group keeps its rows.
    """
    marked = rows.withColumn("_is_row", F.lit(1)).unionByName(
        marks.withColumn("_is_row", F.lit(0)), allowMissingColumns=True
    )
    window = (
        Window.partitionBy(*group)
        .orderBy("_is_row", order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marked.withColumn("_total", F.sum("_add").over(window))
        .filter(F.col("_is_row") == 1)
        .drop("_is_row")
    )


def _rows_before(
    counts: DataFrame, by: Sequence[str], levels: Sequence[int] = LEVEL_BITS
) -> DataFrame:
    """For each block of ``counts`` (by, _block, _add), the sum of the blocks before it as ``_add``."""
    before = F.col("_total") - F.col("_add")
    if levels:
        counts = counts.withColumn("_above", F.shiftright("_block", levels[0]))
        above = counts.groupBy(*by, F.col("_above").alias("_block")).agg(F.sum("_add").alias("_add"))
        marks = _rows_before(above, by, levels[1:]).withColumnRenamed("_block", "_above")
        totals = _running_total(counts, marks, [*by, "_above"], "_block")
    else:
        in_order = Window.partitionBy(*by).orderBy("_block")
        totals = counts.withColumn("_total", F.sum("_add").over(in_order))
    return totals.select(*by, "_block", before.alias("_add"))


def number_rows(
    df: DataFrame, order_key: str, by: Sequence[str] = (), name: str = "row_no"
) -> DataFrame:
    """Add the 1-based position of each row in ``order_key`` order per group.

    ``order_key`` is an integer column, unique and not NULL inside each ``by``
    group. The input is evaluated twice (once for the counts), so it must be
    deterministic; cut the lineage of an expensive one first.
    """
    by = list(by)
    block = F.shiftright(F.col(order_key).cast("long"), BLOCK_BITS)
    one = F.lit(1).cast("long")
    rows = df.withColumns({"_block": block, "_add": one})
    counts = rows.groupBy(*by, "_block").agg(F.count(one).alias("_add"))
    numbered = _running_total(rows, _rows_before(counts, by), [*by, "_block"], order_key)
    return numbered.select(*df.columns, F.col("_total").alias(name))


def number_in_place(
    df: DataFrame,
    order_key: str,
    name: str = "row_no",
    max_runs: int = MAX_RUNS,
    max_file_runs: int = MAX_FILE_RUNS,
) -> DataFrame:
    """``number_rows`` without groups, for rows too wide to be shuffled.

    The rows are written out where they are, each task's sorted by the order key,
    which gives every row a lasting address: its file and its position there. Only
    keys and addresses are shuffled. A row's number minus its position never falls
    inside a file, and stays the same as long as no other file has a key between; so a file
    is a few runs of rows with one such offset, which are the sums of the row counts before them. The
    runs are broadcast, and each row adds its run's offset to its position.

    Files whose keys are interleaved have many runs. Beyond ``max_runs`` in all
    or ``max_file_runs`` in one file the rows are numbered by ``number_rows``,
    with the same result.
    """
    placed = cut_lineage(df.sortWithinPartitions(order_key))
    address = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")]
    numbered = number_rows(placed.select(order_key, *address), order_key, name="_number")
    offset = (F.col("_number") - F.col("_at")).alias("_offset")
    runs = cut_lineage(numbered.groupBy("_file", offset).agg(F.min("_at").alias("_from")))
    sizes = runs.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    if (sizes[0] or 0) > max_runs or (sizes[1] or 0) > max_file_runs:
        return number_rows(placed, order_key, name=name)
    # The rows of a file are those of one task, and its runs at most max_file_runs.
    per_file = runs.groupBy("_file").agg(F.collect_list(F.struct("_from", "_offset")).alias("_runs"))
    rows = placed.select("*", *address).join(F.broadcast(per_file), "_file")
    begun = F.filter("_runs", lambda run: run["_from"] <= F.col("_at"))
    number = F.col("_at") + F.array_max(begun)["_offset"]
    return rows.select(*df.columns, number.alias(name))


def assign_keys(
    df: DataFrame,
    order_key: str,
    name: str,
    existing: DataFrame | None = None,
    first: int = 1,
    wide: bool = False,
) -> DataFrame:
    """Consecutive keys for new rows, following the highest key in ``existing``.

    ``existing`` is the table that already holds keys in column ``name``;
    without one, or when it is empty, keys start at ``first``. ``wide`` rows are
    numbered in place: they are written once and not shuffled.
    """
    last = F.lit(first - 1).cast("long")
    if existing is not None:
        last = F.coalesce(existing.agg(F.max(name).cast("long")).scalar(), last)
    number = number_in_place if wide else number_rows
    numbered = number(df, order_key, name="_position")
    return numbered.select((F.col("_position") + last).alias(name), *df.columns)


def sort_position(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Add a unique integer that increases in the given order.

    For orderings that are not an integer key. The range-partitioned sort
    splits hot values over tasks by the further sort columns. The positions
    depend on the partition bounds, so they are written out before anything
    uses them.
    """
    return cut_lineage(df.orderBy(*order).withColumn(name, F.monotonically_increasing_id()))
