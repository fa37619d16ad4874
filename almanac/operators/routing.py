"""Send rows to branches, or hold a whole table back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.keys import hex_number, keyed_hash


def route(df: DataFrame, branches: Mapping[str, Column], default: str | None, name: str = "branch") -> DataFrame:
    """Label each row with the first branch whose predicate holds."""
    label: Column = F.lit(default)
    for branch, predicate in reversed(list(branches.items())):
        label = F.when(predicate, F.lit(branch)).otherwise(label)
    return df.withColumn(name, label)


def even_minute(ts: str) -> Column:
    return F.minute(ts) % 2 == 0


def random_branch(
    df: DataFrame, key: str, options: Sequence[str], seed: int, name: str = "branch"
) -> DataFrame:
    """Label each row with one of ``options``, drawn from a seeded hash of its key."""
    place = (hex_number(keyed_hash(seed, key), 8) % len(options)).cast("int")
    return df.withColumn(name, F.get(F.array(*map(F.lit, options)), place))


def gate_if(df: DataFrame, condition: DataFrame) -> DataFrame:
    """All rows if the one-row, one-column ``condition`` is true, else none.

    The condition is a scalar subquery, so the plan stays lazy and there is no join.
    """
    return df.where(condition.scalar())


def gate_nonempty(df: DataFrame, other: DataFrame) -> DataFrame:
    """All rows if ``other`` has any row; reads only until the first one is found."""
    return df.where(other.exists())


def payload(message: Column | str) -> Column:
    """JSON object ``{"message": ...}``."""
    return F.to_json(F.struct((F.col(message) if isinstance(message, str) else message).alias("message")))


def trigger_payloads(df: DataFrame, flag: Column, message: Column | str, name: str = "conf") -> DataFrame:
    """Keep rows whose flag holds and give them a payload."""
    return df.where(flag).withColumn(name, payload(message))
