"""The given tables, and the shapes derived from them that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators.metrics import daily_max
from almanac.operators.runlog import FAILED, SKIPPED, SUCCESS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station, date, tmax): a user's largest event value per day."""
    return daily_max(table(spark, sf_dir, "events"), "user_id", "ts", "value")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows with three station attributes, typed like the station files."""
    stations = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("station"),
        F.col("c_nationkey").cast("float").alias("latitude"),
        F.length("c_mktsegment").cast("float").alias("longitude"),
        F.col("c_acctbal").cast("float").alias("elevation"),
    )
    return (
        daily(spark, sf_dir)
        .join(stations, "station")
        .select(
            F.col("station").cast("string").alias("station"),
            "date", "latitude", "longitude", "elevation",
            F.col("tmax").cast("float").alias("tmax"),
        )
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, event_id, ts, state): events read as a log of runs."""
    kind = F.col("event_type")
    state = F.when(kind == "error", FAILED).when(kind == "signup", SKIPPED).otherwise(SUCCESS)
    return table(spark, sf_dir, "events").select("user_id", "event_id", "ts", state.alias("state"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features, label): one row per sample, features and label together."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label"
    )
