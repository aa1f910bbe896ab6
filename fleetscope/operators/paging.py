"""Ordered text built from rows: line by line, or in pages of a size the caller names.

Lines have the same shape at every size. A page is one value, built by its own
task, so neither a task nor a value grows with the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import markup
from fleetscope.functions.clock import int_div
from fleetscope.operators.keys import number_rows


def text_lines(
    df: DataFrame, text: Column, order_key: str, by: Sequence[str] = (), name: str = "line"
) -> DataFrame:
    """``by``, position (from 1) and text of every row in order."""
    lines = df.select(*by, F.col(order_key).alias("_key"), text.alias(name))
    return number_rows(lines, "_key", by=by, name="position").select(*by, "position", name)


def paged_text(
    df: DataFrame,
    text: Column,
    order_key: str,
    by: Sequence[str] = (),
    separator: str = "",
    *,
    page_rows: int,
    name: str = "body",
) -> DataFrame:
    """``by``, page (from 1), number of rows, and their texts joined in order."""
    lines = df.select(*by, F.col(order_key).alias("_key"), text.alias("_text"))
    numbered = number_rows(lines, "_key", by=by, name="_position")
    joined = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_position", "_text"))),
            lambda line: line["_text"],
        ),
        separator,
    )
    page = int_div(F.col("_position") - 1, page_rows) + 1
    return numbered.groupBy(*by, page.alias("page")).agg(
        F.count(F.lit(1)).alias("n_rows"), joined.alias(name)
    )


def html_report(
    df: DataFrame,
    order_key: str,
    by: Sequence[str],
    columns: Sequence[tuple[str, Column]],
    lead: str,
    page_rows: int | None = None,
) -> DataFrame:
    """An HTML message per group: lead text and a table.

    ``columns`` are (title, value) pairs. Cells are escaped. The message comes as lines (section,
    position, line): the opening, a line per row and the end. With ``page_rows`` it comes as whole
    messages (page, n_rows, body) of so many rows each.
    """
    head = f'<html><body>{lead}<br/><br/><table border="1">' + markup.heading_row(
        [title for title, _ in columns]
    )
    end = "</table></body></html>"
    row = markup.table_row([value for _, value in columns])
    if page_rows is not None:
        pages = paged_text(df, row, order_key, by, page_rows=page_rows)
        return pages.withColumn("body", F.concat(F.lit(head), F.col("body"), F.lit(end)))
    lines = text_lines(df, row, order_key, by).select(
        *by, F.lit(2).alias("section"), "position", "line"
    )
    edges = F.explode(
        F.array(
            F.struct(F.lit(1).alias("section"), F.lit(head).alias("line")),
            F.struct(F.lit(3).alias("section"), F.lit(end).alias("line")),
        )
    )
    around = df.select(*by).distinct().select(*by, edges.alias("_edge")).select(
        *by, "_edge.section", F.lit(0).cast("long").alias("position"), "_edge.line"
    )
    return around.unionByName(lines)
