"""Surrogate keys without collisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.keys import SURROGATE_RANGE, surrogate_key
from almanac.operators.indexing import with_row_index
from almanac.staging import stage

# Ranges of the key space that are resolved side by side.
RANGES = 4096


def unique_surrogate_keys(df: DataFrame, id_col: str, name: str = "custom_id", key_range: int = SURROGATE_RANGE) -> DataFrame:
    """Add ``name``: the row's surrogate key or, if that is taken, the next free one.

    Rows stand in the order of (surrogate key, id), and a row gets the greater of its own key and the key before it plus 1; after the
    last key come the free ones from 0 on.  With a row's place i that key is i + the largest (own key - place) up
    to it, so a range of the key space needs to know of the ranges before only how many rows they have and
    the largest such difference: one row for each of ``RANGES`` ranges.  The result depends on the set of ids, not on
    partitions.  Ids must be unique; a NULL id, and more rows than keys, are errors.
    """
    own = F.when(F.col(id_col).isNull(), F.raise_error(f"NULL in id column {id_col}")).otherwise(surrogate_key(id_col)).cast("bigint")
    if key_range != SURROGATE_RANGE:
        own = own % key_range
    inside = Window.partitionBy("__range").orderBy("__own", id_col)
    placed = (
        df.withColumn("__own", own)
        .withColumn("__range", F.floor(F.col("__own") * RANGES / key_range))
        .withColumn("__place", F.row_number().over(inside) - 1)
        .withColumn("__lead", F.max(F.col("__own") - F.col("__place")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    )
    kept = stage(placed, "keys-in-ranges")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        kept.groupBy("__range").agg(F.count("*").alias("__n"), F.max("__lead").alias("__lead"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .withColumn("__least", F.coalesce(F.max(F.col("__lead") - F.col("__before")).over(before), F.lit(0)))
    )
    if (rows := kept.count()) > key_range:
        raise ValueError(f"{rows} rows do not fit into {key_range} keys")
    # As many rows as there are ranges.
    offsets = F.broadcast(ranges.select("__range", "__before", "__least"))
    resolved = kept.join(offsets, "__range").select(
        *df.columns, (F.col("__place") + F.greatest(F.col("__lead"), F.col("__least") + F.col("__before"))).alias(name)
    )
    beyond = stage(resolved.where(F.col(name) >= key_range), "keys-beyond")
    more = beyond.count()
    if not more:
        return resolved
    return resolved.where(F.col(name) < key_range).unionByName(_from_zero(resolved, beyond, more, name, key_range))


def _from_zero(resolved: DataFrame, beyond: DataFrame, more: int, name: str, key_range: int) -> DataFrame:
    """Rows beyond the last key, with the free keys from 0 on."""
    upto = more
    while True:
        taken = resolved.where(F.col(name) < upto).select(F.col(name).alias("__key"))
        if upto >= key_range or upto - taken.count() >= more:
            break
        upto = min(key_range, 2 * upto)
    free = beyond.sparkSession.range(upto).withColumnRenamed("id", "__key").join(taken, "__key", "left_anti")
    numbered = with_row_index(free, ["__key"], "__at")
    return with_row_index(beyond, [name], "__at").join(numbered, "__at").select(
        *[c for c in beyond.columns if c != name], F.col("__key").alias(name)
    )
