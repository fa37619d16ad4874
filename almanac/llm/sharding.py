"""Shards by best-fit-decreasing bin packing of groups that must stay together.

A group is a set of rows with equal texts.  Groups enter the bins largest first,
each into the tightest that still holds it.  Only the items of the packing reach
the driver, and their number depends on the number of shards, not on the data:
a group of more than 1 / ``PIECES`` of a shard is an item (fewer than shards times
``PIECES`` of those exist); smaller groups are first dealt by hash into shards times
``PIECES`` parcels, and a parcel is an item.

Rows are numbered inside each shard by running sums over small units (a parcel or a large
group, further dealt by ``doc_id``), so neither a shard nor a large group is sorted as a whole.

Nulls and odd rows: a null text counts as no bytes, null texts form one group; an empty table
gives an empty result.  Repeated rows are rows of their own and get slots of their own.  Rows
equal in ``doc_id`` and text are interchangeable.  Columns of the input named
like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.apart import own_columns_apart
from almanac.llm.packing_tree import best_fit_decreasing
from almanac.staging import stage

# Bytes that a row takes beside its text.
ROW_BYTES = 8

# Items per shard: finer items give more even shards and more work for the driver.
PIECES = 256

# For very many shards they are coarser: the driver packs about so many items, but no fewer than LEAST_PIECES a shard.
MOST_ITEMS, LEAST_PIECES = 2_000_000, 16

# Items up to which their bins are broadcast: some 24 MB.
MOST_BROADCAST = 1_000_000

# Parts into which each item's rows are dealt for numbering.
UNITS = 64


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def _pack(items: list[tuple[int, int]], shards: int | None, capacity: int | None) -> dict[int, int]:
    """Bins under ``capacity``, or under about the smallest capacity that needs at most ``shards`` bins."""
    if capacity is not None:
        return best_fit_decreasing(items, capacity)
    largest = max((size for _, size in items), default=0)
    mean = -(-sum(size for _, size in items) // shards)
    # With room for the mean and the largest item, a further bin is never opened.
    low, high = max(mean, largest), mean + largest
    while high - low > mean // 20000:
        middle = (low + high) // 2
        if max(best_fit_decreasing(items, middle).values(), default=0) < shards:
            high = middle
        else:
            low = middle + 1
    return best_fit_decreasing(items, high)


@own_columns_apart
def assign(
    docs: DataFrame, shards: int | None = None, capacity: int | None = None, pieces: int = PIECES
) -> DataFrame:
    """``docs`` with size, shard and slot, into ``shards`` bins of near equal bytes, or bins of ``capacity`` bytes.

    Slots number the rows of a shard from 0 without gaps.  A group larger than the capacity fills a shard of its own.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark = docs.sparkSession
    keyed = (
        docs.drop("size", "shard", "slot")
        .withColumn("size", row_size(F.col("text")))
        .withColumn("__group", F.xxhash64("text"))
    )
    groups = stage(keyed.groupBy("__group").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    bins_wanted = shards or max(1, -(-total // capacity))
    n_items = bins_wanted * max(LEAST_PIECES, min(pieces, MOST_ITEMS // bins_wanted))
    limit = total // n_items
    parcel = F.pmod("__group", F.lit(n_items))
    parcels = groups.where(F.col("size") <= limit).groupBy(parcel.alias("item")).agg(F.sum("size").alias("size"))
    large = groups.where(F.col("size") > limit).orderBy("__group").collect()
    sizes = [tuple(r) for r in parcels.collect()] + [(n_items + i, r["size"]) for i, r in enumerate(large)]
    bins = _pack(sizes, shards, capacity)
    of_parcel = spark.createDataFrame(
        [(item, shard) for item, shard in bins.items() if item < n_items], "__parcel bigint, __shard int"
    )
    of_large = spark.createDataFrame(
        [(r["__group"], n_items + i, bins[n_items + i]) for i, r in enumerate(large)],
        "__large bigint, __item bigint, __own int",
    )
    # Both have fewer rows than there may be items, whatever the size of the data.
    if n_items <= MOST_BROADCAST:
        of_large, of_parcel = F.broadcast(of_large), F.broadcast(of_parcel)
    placed = (
        keyed.join(of_large, F.col("__group") == F.col("__large"), "left")
        .join(of_parcel, F.when(F.col("__item").isNull(), parcel) == F.col("__parcel"), "left")
        .withColumn("shard", F.coalesce("__own", "__shard"))
        .withColumn("__item", F.coalesce("__item", "__parcel"))
        .withColumn("__unit", F.pmod(F.xxhash64("doc_id", "__group"), F.lit(UNITS)).cast("int"))
    )
    units = stage(placed.groupBy("shard", "__item", "__unit").agg(F.count("*").alias("rows")), "units")
    before = Window.partitionBy("shard").orderBy("__item", "__unit").rowsBetween(Window.unboundedPreceding, -1)
    first_slots = stage(
        units.select(
            "__item", "__unit", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__first")
        ),
        "first-slots",
    )
    within = Window.partitionBy("__item", "__unit").orderBy("doc_id", "__group")
    return (
        placed.join(first_slots, ["__item", "__unit"])
        .withColumn("slot", (F.col("__first") + F.row_number().over(within) - 1).cast("bigint"))
        .drop("__group", "__large", "__own", "__parcel", "__shard", "__item", "__unit", "__first")
    )
