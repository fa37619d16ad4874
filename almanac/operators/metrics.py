"""Aggregates that judge predictions; all combine map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_max(
    df: DataFrame, station: str, ts: str, value: str, names: Sequence[str] = ("station", "date", "tmax")
) -> DataFrame:
    """Largest value per station and calendar day."""
    by_station, by_day, top = names
    return df.groupBy(F.col(station).alias(by_station), F.col(ts).cast("date").alias(by_day)).agg(
        F.max(value).alias(top)
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row with RMSE, MAE and R2 (rounded to 6 places), over the rows that have both values."""
    y = F.col(actual).cast("double")
    error = y - F.col(predicted).cast("double")
    squared = error * error
    return df.agg(
        F.round(F.sqrt(F.avg(squared)), 6).alias("rmse"),
        F.round(F.avg(F.abs(error)), 6).alias("mae"),
        F.round(1 - F.try_divide(F.avg(squared), F.var_pop(F.when(error.isNotNull(), y))), 6).alias("r2"),
    )


def share_of_zeros(value: Column) -> Column:
    """Aggregate: zeros in percent."""
    return F.round(F.avg(F.when(value == 0, F.lit(100.0)).otherwise(F.lit(0.0))), 6)


def share_correct(predicted: Column | str, label: Column | str) -> Column:
    """Aggregate: accuracy."""
    hit = _col(predicted).cast("double") == _col(label).cast("double")
    return F.round(F.avg(F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0))), 6)


def accuracy(df: DataFrame, predicted: Column | str, label: Column | str) -> DataFrame:
    return df.agg(share_correct(predicted, label).alias("acc"), F.count("*").alias("n"))


def tall_predictions(df: DataFrame, predictions: Mapping[str, Column]) -> DataFrame:
    """One row per input row and model, from a single scan."""
    entries = [
        F.struct(F.lit(model).alias("model"), predicted.cast("double").alias("pred"))
        for model, predicted in predictions.items()
    ]
    return df.select("*", F.inline(F.array(*entries)))


def compare_predictors(tall: DataFrame, label: str) -> DataFrame:
    """Accuracy per model over a tall prediction table."""
    return tall.groupBy("model").agg(share_correct("pred", label).alias("acc"), F.count("*").alias("n"))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
