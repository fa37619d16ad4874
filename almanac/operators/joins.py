"""Day-lag self join and key alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def yesterday_join(
    daily: DataFrame, station: str = "station", day: str = "date", value: str = "tmax"
) -> DataFrame:
    """Each row with the same station's value of exactly the day before.

    Rows without a predecessor day drop out, and gaps are never bridged, which
    ``lag`` would do.  Both keys are hashed, so a station with most of the rows is
    spread over its days; ``daily`` should hold one row per station and day.
    """
    # Stating the join's NULL checks here makes both sides the same plan, so that
    # one shuffle of ``daily`` serves both.
    next_day = F.date_add(day, 1)
    known = daily.where(F.col(station).isNotNull() & F.col(day).isNotNull() & next_day.isNotNull())
    before = known.select(station, next_day.alias(day), F.col(value).alias(f"yesterday_{value}"))
    return known.join(before, [station, day])


def align_on_key(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Pair features and labels by row id instead of by position."""
    return features.join(labels, key)

