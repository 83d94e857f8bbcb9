"""The old generation in a foreign database, read-only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def jdbc_source(spark: SparkSession, url: str, schema: str, options: dict[str, str] | None = None, partitioned: dict[str, tuple[str, int, int, int]] | None = None) -> Callable[[str], DataFrame]:
    """A function from a table's name to its rows, for Repair's `source`. partitioned: by table a whole-number column, its bounds and the number of partitions, so that a large table is read by
    many tasks; filters and columns reach the database."""

    def read(table: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"{schema}.{table}").options(**(options or {}))
        if partitioned and table in partitioned:
            column, low, high, number = partitioned[table]
            reader = reader.option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", number)
        return reader.load()

    return read
