"""Text and HTML building blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def escape(text: Column) -> Column:
    """``&``, ``<`` and ``>`` as entities."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def cell(value: Column) -> Column:
    """A table cell with escaped content; a missing value is an empty cell."""
    return F.concat(F.lit("<td>"), F.coalesce(escape(value.cast("string")), F.lit("")), F.lit("</td>"))


def table_row(values: Sequence[Column]) -> Column:
    return F.concat(F.lit('<tr valign="top">'), *[cell(v) for v in values], F.lit("</tr>"))


def heading_row(titles: Sequence[str]) -> str:
    return '<tr valign="top">' + "".join(f"<th>{t}</th>" for t in titles) + "</tr>"


def bracketed(name: Column) -> Column:
    """``[name]``, with a closing bracket inside the name doubled."""
    return F.concat(F.lit("["), F.replace(name, F.lit("]"), F.lit("]]")), F.lit("]"))


def replace_all(text: Column, replacements: Mapping[str, str]) -> Column:
    """Literal replacements, applied in the given order."""
    for search, value in replacements.items():
        text = F.replace(text, F.lit(search), F.lit(value))
    return text
