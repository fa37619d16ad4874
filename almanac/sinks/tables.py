"""Create tables, guard NOT NULL columns, append rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the sink table, none of which may be NULL.
SINK_COLUMNS = {"custom_id": "INT", "timestamp": "TIMESTAMP_NTZ", "user_id": "VARCHAR(50)"}


def create_table(
    spark: SparkSession, name: str, columns: dict[str, str] = SINK_COLUMNS, location: str | None = None
) -> None:
    """Create the table ``name`` or ``database.name`` unless it is there already."""
    ddl = ", ".join(f"{quoted(column)} {kind} NOT NULL" for column, kind in columns.items())
    place = "" if location is None else " LOCATION '{}'".format(location.replace("\\", "\\\\").replace("'", "\\'"))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(name)} ({ddl}) USING parquet{place}")


def quoted(name: str) -> str:
    """One identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def qualified(name: str) -> str:
    return ".".join(map(quoted, name.split(".")))


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; a NULL in any of ``columns`` is an error naming the column.

    Spark's file tables accept NULL in NOT NULL columns, so the check is part of the query.
    """
    checked = {
        c: F.when(F.col(c).isNull(), F.raise_error(f"NULL in NOT NULL column {c}")).otherwise(F.col(c))
        for c in columns
    }
    return df.withColumns(checked)


def split_nulls(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy NOT NULL on ``columns``, and those that do not."""
    broken = reduce(or_, [F.col(c).isNull() for c in columns])
    return df.where(~broken), df.where(broken)


def null_violations(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """(table_name, column_name, violations) from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("violations"))
        for c in columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def append_rows(df: DataFrame, table: str, required: Sequence[str]) -> None:
    """Append by column name; rejects NULL in ``required`` and over-long VARCHAR values."""
    columns = df.sparkSession.table(table).columns
    require_not_null(df.select(*columns), required).write.insertInto(table)


def insert_row(spark: SparkSession, table: str, values: Sequence) -> None:
    """Insert one row; values are bound, never spliced into the text."""
    if any(v is None for v in values):
        raise ValueError("NULL in a NOT NULL column")
    marks = ", ".join("?" * len(values))
    spark.sql(f"INSERT INTO {qualified(table)} VALUES ({marks})", args=list(values))


def append_jdbc(
    df: DataFrame, url: str, table: str, required: Sequence[str], batch_size: int = 10_000,
    max_connections: int = 32, **options: str,
) -> None:
    """Append to a database table; ``max_connections`` bounds the load on the database.

    Each task writes in one transaction.  Give the table a unique key: a task that is lost
    after its commit is run again.
    """
    writer = require_not_null(df, required).write.format("jdbc").mode("append")
    writer.options(
        url=url, dbtable=table, batchsize=str(batch_size), numPartitions=str(max_connections), **options
    ).save()
