"""Split, fit and forecast daily maxima."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from almanac.models.forest import SEASON_FEATURES
from almanac.models.histogram_forest import HistogramForest, fit_histogram_forest
from almanac.operators.reshape import day_of_year
from almanac.operators.splits import weighted_split

# Shares of the two parts.
SHARES = {"train": 0.75, "validation": 0.25}


# A row is a station's day.
KEY = ("station", "date")


def parts_of(observed: DataFrame, seed: int = 15) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows with their day of year; a row's part depends on its station and date only."""
    parts = weighted_split(day_of_year(observed), list(KEY), SHARES, seed)
    return parts.where("part = 'train'").drop("part"), parts.where("part = 'validation'").drop("part")


def grow(observed: DataFrame, features: Sequence[str] = SEASON_FEATURES, seed: int = 15) -> HistogramForest:
    train, _ = parts_of(observed, seed)
    return fit_histogram_forest(train, features, "tmax", KEY, seed=seed)


def forecast(observed: DataFrame, features: Sequence[str] = SEASON_FEATURES, seed: int = 15) -> DataFrame:
    """(station, date, tmax, prediction) of the validation rows."""
    _, validation = parts_of(observed, seed)
    return grow(observed, features, seed).predict(validation).select(*KEY, "tmax", "prediction")
