"""Concatenate, parse, project, flatten and assemble."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_tables(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union by name: column order of the first table, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def parse_date(df: DataFrame, column: str, fmt: str = "yyyy-MM-dd", into: str | None = None) -> DataFrame:
    """Replace text by a date; text that is not a date is an error."""
    text = F.col(column)
    parsed = F.try_to_date(text, fmt)
    bad = text.isNotNull() & parsed.isNull()
    message = F.concat(F.lit(f"not a date in column {column}: "), text)
    return df.withColumn(into or column, F.when(bad, F.raise_error(message)).otherwise(parsed))


def split_by_date(df: DataFrame, column: str, fmt: str = "yyyy-MM-dd") -> tuple[DataFrame, DataFrame]:
    """Rows whose text parses, with the date in place, and the untouched rest."""
    parsed = F.try_to_date(F.col(column), fmt)
    good = df.where(F.col(column).isNull() | parsed.isNotNull()).withColumn(column, parsed)
    return good, df.where(F.col(column).isNotNull() & parsed.isNull())


def day_of_year(df: DataFrame, column: str = "date", name: str = "day_of_year") -> DataFrame:
    return df.withColumn(name, F.dayofyear(column))


def sql_over(df: DataFrame, statement: str) -> DataFrame:
    """Run a SELECT in which ``__THIS__`` stands for ``df``."""
    return SQLTransformer(statement=statement).transform(df)


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """Top ``n`` of a stated order; each task keeps only ``n`` rows."""
    return df.orderBy(*order_by).limit(n)


def flatten_nested(column: str) -> Column:
    """Array of arrays to one array."""
    return F.flatten(column)


def array_to_columns(df: DataFrame, column: str, width: int, prefix: str = "p") -> DataFrame:
    """One DOUBLE column per element; a row of any other width is an error."""
    array = F.col(column)
    checked = F.when(
        F.size(array) != width,
        F.raise_error(F.concat(F.lit(f"expected {width} elements, got "), F.size(array).cast("string"))),
    ).otherwise(array)
    kept = [c for c in df.columns if c != column]
    return df.withColumn(column, checked).select(
        *kept, *[F.get(column, F.lit(i)).cast("double").alias(f"{prefix}{i}") for i in range(width)]
    )


def columns_to_array(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Inverse of :func:`array_to_columns`."""
    kept = [c for c in df.columns if c not in set(columns)]
    return df.select(*kept, F.array(*[F.col(c).cast("double") for c in columns]).alias(name))


def assemble_features(
    df: DataFrame, columns: Sequence[str], name: str = "features", invalid: str = "error"
) -> DataFrame:
    """One feature vector per row; ``invalid`` is error, skip or keep."""
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid=invalid).transform(df)
