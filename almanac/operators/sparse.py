"""Vectors stored as the places and values of their elements that are not zero.

The stored form is a struct ``(width, places, numbers)``, places ascending from 0.  Rows and every step
below take memory by the elements that are not zero; nothing is filled in with zeros again but by :func:`to_dense`.

A null vector stays null and counts nowhere; a null element and a vector of another width than the rest are errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLACED = "array<struct<place:int,number:double>>"


def to_sparse(vector: Column | str) -> Column:
    """Stored form of an array of numbers."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    complete = F.when(F.exists(vector, lambda x: x.isNull()), F.raise_error(F.lit("a vector with a null element"))).otherwise(vector)
    placed = F.transform(complete, lambda x, i: F.struct(i.alias("place"), x.cast("double").alias("number")))
    kept = F.filter(placed, lambda e: e["number"] != 0).cast(_PLACED)
    return F.when(
        vector.isNotNull(),
        F.struct(F.size(vector).alias("width"), kept["place"].alias("places"), kept["number"].alias("numbers")),
    )


def to_dense(vector: Column | str) -> Column:
    """Array of doubles of a stored vector."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    found = F.map_from_arrays(vector["places"], vector["numbers"])
    zeros = F.when(vector["width"] > 0, F.sequence(F.lit(0), vector["width"] - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(vector.isNotNull(), F.transform(zeros, lambda i: F.coalesce(F.element_at(found, i), F.lit(0.0))))


def entries(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """(keys, pos, x): one row for each element that is not zero."""
    return df.select(*keys, F.inline(F.arrays_zip(F.col(f"{column}.places").alias("pos"), F.col(f"{column}.numbers").alias("x"))))


def _filled(df: DataFrame, column: str) -> DataFrame:
    """(pos, n, m, mean, squares) of each place: vectors, elements not zero, their mean and their squared deviations."""
    vector = F.col(column)
    sizes = df.where(vector.isNotNull()).agg(
        F.count("*").alias("n"), F.min(vector["width"]).alias("least"), F.max(vector["width"]).alias("most")
    )
    other = F.concat(F.lit("vectors of "), F.col("least").cast("string"), F.lit(" and of "), F.col("most").cast("string"), F.lit(" elements"))
    width = F.when(F.col("least") != F.col("most"), F.raise_error(other)).otherwise(F.col("most"))
    places = sizes.withColumn("width", width).where("width > 0").select("n", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("pos"))
    seen = entries(df, column).groupBy("pos").agg(
        F.count("*").alias("m"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("*")).alias("squares")
    )
    return places.join(seen, "pos", "left").na.fill(0, ["m"]).na.fill(0.0, ["mean", "squares"])


def sparse_feature_stats(df: DataFrame, column: str) -> DataFrame:
    """(pos, mean, sd), zeros included: the moments of what is not zero are joined with those of the zeros.

    One row for each place and task is shuffled; a place without any number has mean and deviation 0.
    """
    share = F.col("m") / F.col("n")
    # Deviations of two groups: within the numbers, and between their mean and the zeros'.
    squares = F.col("squares") + F.col("m") * F.col("mean") * F.col("mean") * (1 - share)
    return _filled(df, column).select("pos", (F.col("mean") * share).alias("mean"), F.sqrt(squares / F.col("n")).alias("sd"))


def sparse_zero_share(df: DataFrame, column: str) -> DataFrame:
    """(pos, zero_pct): zeros of each place in percent."""
    return _filled(df, column).select("pos", F.round((F.col("n") - F.col("m")) * 100.0 / F.col("n"), 6).alias("zero_pct"))


def standardized_products(df: DataFrame, key: str, column: str, stats: DataFrame, weights: DataFrame) -> DataFrame:
    """(key, product): inner product of each standardised vector with weights, the vectors left as they are.

    ``stats`` is (pos, mean, sd) and ``weights`` (pos, weight).  With u = weight / sd, 1 for a deviation of 0, the product is
    sum(u * x) over the numbers less sum(u * mean) over all places, which is one value for the whole table.  Both small
    tables, as wide as the vectors, become one array that the rows look their places up in.
    """
    scale = F.col("weight") / F.when(F.col("sd") == 0, 1.0).otherwise(F.col("sd"))
    fitted = (
        stats.join(weights, "pos")
        .select("pos", scale.alias("u"), (scale * F.col("mean")).alias("shift"))
        .agg(
            F.map_from_entries(F.collect_list(F.struct("pos", "u"))).alias("u"), F.coalesce(F.sum("shift"), F.lit(0.0)).alias("shift")
        )
        .select(F.struct("u", "shift").alias("fitted"))
    )
    vector, known = F.col(column), F.col("fitted")
    terms = F.zip_with(
        vector["places"], vector["numbers"], lambda place, x: x * F.coalesce(F.element_at(known["u"], place), F.lit(0.0))
    )
    product = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term) - known["shift"]
    return df.select(F.col(key), vector.alias(column)).withColumn("fitted", fitted.scalar()).select(key, product.alias("product"))
