"""Per-feature statistics and standardisation of array features."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_scaler(df: DataFrame, column: str) -> DataFrame:
    """One row ``(n, mean, sd)``: arrays of means and population deviations.

    Each task keeps two vectors as wide as the features, whatever its row count.  Rows without a vector do not count.
    """
    vector = array_to_vector(F.col(column))
    stats = df.where(F.col(column).isNotNull()).select(Summarizer.metrics("count", "mean", "variance").summary(vector).alias("s"))
    n = F.col("s.count")
    return stats.select(
        n.alias("n"),
        vector_to_array("s.mean").alias("mean"),
        F.transform(vector_to_array("s.variance"), lambda v: F.sqrt(v * (n - 1) / n)).alias("sd"),
    )


def feature_stats(df: DataFrame, column: str) -> DataFrame:
    """The scaler as rows ``(pos, mean, sd)``."""
    return (
        fit_scaler(df, column)
        .select(F.posexplode(F.arrays_zip("mean", "sd")).alias("pos", "stat"))
        .select("pos", "stat.mean", "stat.sd")
    )


def standardize(df: DataFrame, column: str, scaler: DataFrame, name: str = "scaled") -> DataFrame:
    """``(x - mean) / sd`` with statistics fitted elsewhere; constant features become 0.

    A vector of another width than the scaler's is an error.
    """
    fitted = scaler.select(F.arrays_zip("mean", "sd")).scalar()
    other_width = F.concat(
        F.lit("expected "), F.size("__fitted").cast("string"), F.lit(" elements, got "), F.size(column).cast("string")
    )
    checked = F.when(F.size(column) != F.size("__fitted"), F.raise_error(other_width)).otherwise(F.col(column))
    scaled = F.zip_with(
        checked,
        F.col("__fitted"),
        lambda x, s: (x.cast("double") - s["mean"]) / F.when(s["sd"] == 0, 1.0).otherwise(s["sd"]),
    )
    return df.withColumn("__fitted", fitted).withColumn(name, scaled).drop("__fitted")
