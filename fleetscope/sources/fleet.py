"""The same table collected from every server and stacked."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def collect_fleet(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``{server: frame}`` to one frame with a ``server`` column."""
    tagged = [frame.withColumn("server", F.lit(server)) for server, frame in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


@dataclass(frozen=True)
class Split:
    """Ranges of a numeric or date column that are read by separate tasks.

    The bounds only shape the ranges; rows outside them are read as well.
    """

    column: str
    low: str
    high: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.low,
            "upperBound": self.high,
            "numPartitions": str(self.parts),
        }


def jdbc_fleet(
    spark: SparkSession,
    urls: Mapping[str, str],
    table: str,
    splits: Mapping[str, Split] | None = None,
    **options: str,
) -> DataFrame:
    """One JDBC frame per server; filters and columns are pushed to each server.

    A server with a large table gets a ``Split``, others are read by one task
    each. Credentials come in ``options`` or the driver's own store, never from
    code.
    """
    splits = splits or {}
    frames = {}
    for server, url in urls.items():
        ranges = splits[server].options() if server in splits else {}
        reader = spark.read.format("jdbc").options(url=url, dbtable=table, **ranges, **options)
        frames[server] = reader.load()
    return collect_fleet(frames)


def read_fleet(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """Files laid out as ``root/server=<name>/``, the server taken from the path.

    For large fleets: one scan with partition pruning, however many servers.
    """
    return spark.read.schema(schema).option("basePath", root).parquet(root)
