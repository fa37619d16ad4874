"""Seeded splits whose result does not depend on partitioning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.keys import hex_number, keyed_hash
from almanac.operators import indexing

_HASH_DIGITS = 8
_HASH_SPACE = 16**_HASH_DIGITS


def weighted_split(
    df: DataFrame, key: str | list[str], weights: Mapping[str, float], seed: int, name: str = "part"
) -> DataFrame:
    """Label every row with one part; shares follow ``weights`` approximately.

    No shuffle and no second scan: the label is an expression of the row's key.
    """
    keys = [key] if isinstance(key, str) else key
    draw = hex_number(keyed_hash(seed, *keys), _HASH_DIGITS)
    parts, total, upto = list(weights), sum(weights.values()), 0.0
    label: Column = F.lit(parts[-1])
    bounds = []
    for part in parts[:-1]:
        upto += weights[part]
        bounds.append((round(upto / total * _HASH_SPACE), part))
    for bound, part in reversed(bounds):
        label = F.when(draw < bound, F.lit(part)).otherwise(label)
    return df.withColumn(name, label)


def exact_split(
    df: DataFrame,
    id_col: str,
    train_size: int | float,
    test_size: int | float,
    seed: int,
    name: str = "part",
) -> DataFrame:
    """Disjoint random train and test sets of exact sizes; other rows are dropped.

    Sizes are row counts (int) or shares of the table (float; train rounds down,
    test rounds up).  Features and label stay in one row, so they cannot get out
    of step.  Asking for more rows than there are is an error, save that an empty
    table gives an empty split.
    """
    hashed = indexing.hashed_rows(df, id_col, seed)
    sizes = indexing.bucket_sizes(hashed)
    total = F.coalesce(F.sum("count"), F.lit(0))
    n_train, n_test = _rows(train_size, total, F.floor), _rows(test_size, total, F.ceil)
    plan = sizes.agg(total.alias("total"), n_train.alias("train"), n_test.alias("test")).select(
        F.when(
            F.col("train") + F.col("test") > F.col("total"),
            F.raise_error("train_size + test_size exceeds the number of rows"),
        )
        .otherwise(F.struct("train", (F.col("train") + F.col("test")).alias("used")))
        .alias("plan")
    )
    cut = plan.scalar()
    placed = indexing.place_rows(
        hashed, indexing.bucket_offsets(sizes), id_col, "__pos", below=cut["used"]
    )
    return (
        placed.where(F.col("__pos") < cut["used"])
        .withColumn(name, F.when(F.col("__pos") < cut["train"], "train").otherwise("test"))
        .drop("__pos")
    )


def _rows(size: int | float, total: Column, rounding) -> Column:
    return F.lit(size).cast("bigint") if isinstance(size, int) else rounding(total * F.lit(size)).cast("bigint")
