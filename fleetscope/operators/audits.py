"""Checks of rules that files do not enforce."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def placement_violations(
    indexes: DataFrame, data_spaces: DataFrame, schema_name: str, allowed_space: str
) -> DataFrame:
    """Indexes of a schema that lie in another data space than the allowed one."""
    return (
        indexes.filter(F.col("schema_name") == schema_name)
        .join(data_spaces, "data_space_id", "left")
        .filter(~F.col("data_space").eqNullSafe(F.lit(allowed_space)))
        .select("schema_name", "table_name", "index_name", "data_space_id", "data_space")
    )


def key_constraint_audit(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are missing or occur more than once."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        table.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(missing | (F.col("n_rows") > 1))
        .withColumn("problem", F.when(missing, "missing").otherwise("duplicate"))
    )


def foreign_key_audit(children: DataFrame, parents: DataFrame, key: Sequence[str]) -> DataFrame:
    """Children whose parent does not exist; a key with a NULL refers to nothing."""
    key = list(key)
    return children.dropna(subset=key).join(parents.select(*key), key, "left_anti").select(
        *children.columns
    )
