"""Global row numbers without sorting the whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.keys import keyed_hash
from almanac.staging import stage

_PART, _LOCAL, _OFFSET = "__part", "__local", "__offset"
_HASH, _BUCKET = "__hash", "__bucket"

# monotonically_increasing_id keeps the row's place in its partition in the low 33 bits.
_LOCAL_MASK = (1 << 33) - 1


def with_row_index(df: DataFrame, order_by: Sequence[str], name: str = "idx") -> DataFrame:
    """Add ``name`` = 0..n-1 in the order of ``order_by``, which must be unique per row.

    Rows are range-partitioned and sorted by all cores, written once with their
    place in their partition, and shifted by the sizes of the partitions before.
    The sizes table has one row per partition, which bounds the broadcast.
    """
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_LOCAL, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_MASK)))
    )
    staged = stage(placed, "row-index")
    offsets = running_offsets(staged.groupBy(_PART).count(), _PART)
    return staged.join(F.broadcast(offsets), _PART).select(
        *df.columns, (F.col(_OFFSET) + F.col(_LOCAL)).alias(name)
    )


def permuted(df: DataFrame, id_col: str, seed: int, name: str = "pos") -> DataFrame:
    """Add ``name`` = place of the row in a seeded random permutation, 0..n-1."""
    hashed = hashed_rows(df, id_col, seed)
    return place_rows(hashed, bucket_offsets(bucket_sizes(hashed)), id_col, name)


def hashed_rows(df: DataFrame, id_col: str, seed: int, digits: int = 4) -> DataFrame:
    """Give every row its seeded hash and the hash prefix that names its bucket.

    Buckets are even however skewed the data are, since they come from a hash of
    a unique id, and their order is the order of the hashes.  A row without an id is an error.
    """
    known = F.when(F.col(id_col).isNull(), F.raise_error(f"NULL in id column {id_col}")).otherwise(F.col(id_col))
    return df.withColumn(_HASH, keyed_hash(seed, known)).withColumn(        _BUCKET, F.substring(_HASH, 1, digits)
    )


def bucket_sizes(hashed: DataFrame) -> DataFrame:
    """One row per bucket, at most ``16 ** digits`` of them."""
    return hashed.groupBy(_BUCKET).count()


def bucket_offsets(sizes: DataFrame) -> DataFrame:
    return running_offsets(sizes, _BUCKET)


def place_rows(
    hashed: DataFrame, offsets: DataFrame, id_col: str, name: str, below: Column | None = None
) -> DataFrame:
    """Number the rows inside their buckets and add the bucket's offset.

    With ``below`` only buckets that start before that place are shuffled.
    """
    if below is not None:
        offsets = offsets.where(F.col(_OFFSET) < below)
    inside = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(_HASH, id_col)) - 1
    return (
        hashed.join(F.broadcast(offsets), _BUCKET)
        .withColumn(name, F.col(_OFFSET) + inside)
        .drop(_HASH, _BUCKET, _OFFSET)
    )


def running_offsets(sizes: DataFrame, key: str) -> DataFrame:
    """Rows before each ``key``.  ``sizes`` has one row per partition or bucket, not per data row."""
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(key, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(_OFFSET))
