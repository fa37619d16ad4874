"""Relational tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def partitioned_read(key: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """JDBC options that read ``partitions`` key ranges side by side.

    The bounds place the cuts; rows outside them are still read.
    """
    if not lower < upper or partitions < 1:
        raise ValueError("need lower < upper and at least one partition")
    return {
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int,
    fetch_size: int = 10_000, **options: str,
) -> DataFrame:
    """A table of a database, in ranges of a numeric key; filters run in the database."""
    ranges = partitioned_read(key, lower, upper, partitions)
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=str(fetch_size))
    return reader.options(**ranges, **options).load()
