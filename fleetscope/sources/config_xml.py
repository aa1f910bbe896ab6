"""Configuration documents: repeating elements and name/value settings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text is taken as it stands, and an empty attribute is an empty text.
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}


def read_elements(
    spark: SparkSession, path: str, element: str, attributes: Sequence[str]
) -> DataFrame:
    """Rows of one repeating element from XML files, split over tasks."""
    schema = ", ".join(f"`_{a}` string" for a in attributes)
    frame = (
        spark.read.format("xml")
        .options(rowTag=element, **XML_OPTIONS)
        .schema(schema)
        .load(path)
    )
    return frame.select(*[F.col(f"`_{a}`").alias(a) for a in attributes])


def element_array(xml: Column, path: str, attributes: Sequence[str]) -> Column:
    """All elements at ``path`` below the root, in document order.

    Every level may repeat. The result is an array of structs with one string
    field ``_name`` per attribute; it is empty where nothing matches.
    """
    return _elements_at(_parsed(xml, [path], attributes), path)


def _parsed(xml: Column, paths: Sequence[str], attributes: Sequence[str]) -> Column:
    """The document with just the elements on ``paths``; each path's last one has the attributes."""

    def fields(levels: list[list[str]]) -> str:
        found = [f"`_{a}`: string" for a in attributes] if [] in levels else []
        for name in dict.fromkeys(level[0] for level in levels if level):
            below = [level[1:] for level in levels if level and level[0] == name]
            found.append(f"`{name}`: array<struct<{fields(below)}>>")
        return ", ".join(found)

    kind = f"struct<{fields([path.split('/') for path in paths])}>"
    return F.from_xml(xml, kind, XML_OPTIONS)


def _elements_at(document: Column, path: str) -> Column:
    first, *further = path.split("/")
    found = F.coalesce(document[first], F.array())
    for level in further:
        found = _children(found, level)
    return found


def _children(nodes: Column, name: str) -> Column:
    return F.flatten(F.transform(nodes, lambda node: F.coalesce(node[name], F.array())))


def shred_elements(
    docs: DataFrame, path: str, attributes: Sequence[str], xml: str = "xml", keep: str = "doc_id"
) -> DataFrame:
    """One row per element at ``path``, one column per attribute."""
    rows = docs.select(keep, F.explode(element_array(F.col(xml), path, attributes)).alias("node"))
    return rows.select(keep, *[F.col(f"node.`_{a}`").alias(a) for a in attributes])


def pivot_settings(
    docs: DataFrame,
    path: str,
    names: Mapping[str, str],
    xml: str = "xml",
    keep: str = "doc_id",
    name_attribute: str = "Name",
    value_attribute: str = "Value",
) -> DataFrame:
    """Name/value elements of each document as one wide typed row.

    ``names`` maps setting names to Spark types. The first element of a name
    counts; an absent name, or a value its type cannot hold, gives NULL. The
    look-up stays inside the row, so nothing is shuffled.
    """
    settings = element_array(F.col(xml), path, [name_attribute, value_attribute])
    parsed = docs.select(keep, settings.alias("settings"))

    def value(name: str) -> Column:
        hits = F.filter("settings", lambda s: s[f"_{name_attribute}"] == F.lit(name))
        return F.get(hits, F.lit(0))[f"_{value_attribute}"]

    return parsed.select(
        keep, *[value(name).try_cast(kind).alias(name) for name, kind in names.items()]
    )


def instance_topology(
    docs: DataFrame,
    primary_path: str,
    secondary_path: str,
    attributes: Sequence[str],
    keep: str = "doc_id",
    xml: str = "xml",
) -> DataFrame:
    """Primary and secondary instances of each document, duplicates removed.

    A document is parsed once and its duplicates are found inside the row, so
    nothing is shuffled.
    """
    paths = [primary_path, secondary_path]
    parsed = docs.select(keep, _parsed(F.col(xml), paths, attributes).alias("_doc"))
    nodes = F.concat(*[_elements_at(F.col("_doc"), path) for path in paths])
    rows = parsed.select(keep, F.explode(F.array_distinct(nodes)).alias("node"))
    return rows.select(keep, *[F.col(f"node.`_{a}`").alias(a) for a in attributes])
