"""Script templates read as whole files and filled in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions.markup import replace_all

# A byte-order mark, decoded as UTF-8 and as a one-byte code page.
BYTE_ORDER_MARKS = ("﻿", "ï»¿")


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its path and whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("template")
    )


def render(template: Column, placeholders: Mapping[str, str]) -> Column:
    """Byte-order marks removed, then placeholders replaced in the given order."""
    clean = replace_all(template, {mark: "" for mark in BYTE_ORDER_MARKS})
    return replace_all(clean, placeholders)
