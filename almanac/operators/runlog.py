"""Operators on logs of recurring runs ``(key, ts, state)`` and their schedules."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.schedule import seconds_of, step_of
from almanac.functions.text import ds, ds_add
from almanac.staging import stage

# The states a finished run can be in.
SUCCESS, FAILED, SKIPPED = "success", "failed", "skipped"

# Slots that one row of the calendar's first step stands for.
RUN = 10_000


def trigger_rules(runs: DataFrame, by: Sequence, state: str = "state") -> DataFrame:
    """Which downstream rules each group of runs satisfies.

    A skipped run defeats ``all_success`` and leaves ``one_success`` alone.  A run without a
    state has neither succeeded nor finished.
    """
    succeeded = F.coalesce(F.col(state) == SUCCESS, F.lit(False))
    finished = F.coalesce(F.col(state).isin(SUCCESS, FAILED, SKIPPED), F.lit(False))
    return runs.groupBy(*by).agg(
        F.bool_and(succeeded).alias("all_success"),
        F.bool_or(succeeded).alias("one_success"),
        F.bool_and(finished).alias("all_done"),
        F.count("*").alias("n"),
    )


def depends_on_past(
    runs: DataFrame, key: str, order_by: Sequence[str], state: str = "state", name: str = "eligible"
) -> DataFrame:
    """A run is eligible unless an earlier run of its key failed.

    Only the first failure of a key matters, so the history is one aggregate per
    key joined back to the runs; no task ever sorts the whole history of a key.  The
    history is written first: both sides of the join are then plain scans, a small history is
    broadcast by its size, and adaptive execution can split a key that holds most runs.
    """
    place = F.struct(*order_by)
    failures = runs.where(F.col(state) == FAILED)
    history = stage(
        failures.groupBy(F.col(key).alias("__key")).agg(F.min(place).alias("__first_failure")), "first-failures"
    )
    eligible = F.col("__first_failure").isNull() | (place <= F.col("__first_failure"))
    joined = runs.join(history, F.col(key).eqNullSafe(F.col("__key")), "left")
    return joined.withColumn(name, eligible).drop("__key", "__first_failure")


def latest_only(df: DataFrame, ts: str, every: str | timedelta) -> DataFrame:
    """Rows of the most recent schedule interval, e.g. ``every="4 hours"`` or ``"@daily"``.

    The interval start is a scalar subquery, which the scan uses to skip row groups.
    """
    start = df.agg(F.max(ts).alias(ts)).select(F.window(ts, step_of(every))["start"]).scalar()
    return df.where(F.col(ts) >= start)


def schedule_grid(
    df: DataFrame, ts: str, every: str | timedelta, counted: str, catchup: bool = True,
    start: str | None = None, end: str | None = None,
) -> DataFrame:
    """One row ``(slot, n)`` per interval from ``start`` to ``end``, with 0 for gaps.

    ``n`` counts the non-NULL ``counted`` values in the interval.  The bounds default to
    the data's own; intervals are aligned to the epoch like ``window``.  The data are
    counted per slot; the calendar of slots is made in runs of ``RUN`` by all tasks and joined with the
    counts.  Zoned instants are taken at the session's clock.  Without ``catchup`` only the last interval remains.
    """
    every = step_of(every)
    step = F.expr(f"INTERVAL {every}")
    # Slots have a fixed length, which steps of a day do not have where clocks change.
    df = df.withColumn(ts, F.col(ts).cast("timestamp_ntz"))
    marks = [_empty_slot(df, bound, every) for bound in (start, end) if bound is not None]
    if start is not None:
        df = df.where(F.col(ts) >= _slot_of(df, start, every))
    if end is not None:
        df = df.where(F.col(ts) < _slot_of(df, end, every) + step)
    if not catchup:
        df = latest_only(df, ts, every) if end is None else df.where(F.col(ts) >= _slot_of(df, end, every))
        marks = marks[-1:] if end is not None else []
    counts = df.groupBy(F.window(ts, every)["start"].alias("slot")).agg(F.count(counted).alias("n"))
    if marks:
        counts = reduce(DataFrame.unionByName, marks, counts).groupBy("slot").agg(F.sum("n").alias("n"))
    counts = stage(counts, "slot-counts")
    first, last = counts.agg(F.min("slot"), F.max("slot")).first()
    if first is None:
        return counts.select("slot", "n")
    return _calendar(df.sparkSession, first, last, every).join(counts, "slot", "left").select(
        "slot", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def _calendar(spark: SparkSession, first: datetime, last: datetime, every: str) -> DataFrame:
    """(slot) from ``first`` to ``last``; every task makes whole runs of slots."""
    seconds = seconds_of(every)
    slots = int((last - first).total_seconds()) // seconds + 1
    places = spark.range(-(-slots // RUN)).select(
        F.explode(F.sequence(F.col("id") * RUN, F.least((F.col("id") + 1) * RUN, F.lit(slots)) - 1)).alias("place")
    )
    second = F.expr("INTERVAL '1' SECOND")
    return places.select((F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz") + second * (F.col("place") * seconds)).alias("slot"))


def _slot_of(df: DataFrame, instant: str, every: str) -> Column:
    return _empty_slot(df, instant, every).select("slot").scalar()


def _empty_slot(df: DataFrame, instant: str, every: str) -> DataFrame:
    """The slot that holds ``instant``, with a count of 0."""
    one = df.sparkSession.range(1).select(F.lit(instant).cast("timestamp_ntz").alias("at"))
    return one.select(F.window("at", every)["start"].alias("slot"), F.lit(0).cast("bigint").alias("n"))


def latest_per_key(df: DataFrame, key: str, order_by: Sequence[str], values: Sequence) -> DataFrame:
    """Newest message of each key; values may be scalars, arrays or maps."""
    newest = F.max_by(F.struct(*values), F.struct(*order_by)).alias("__newest")
    return df.groupBy(key).agg(newest).select(key, "__newest.*")


def date_macros(df: DataFrame, ts: str, add_days: int = 7, repeat: int = 5) -> DataFrame:
    """Run date, run date plus ``add_days``, and ``repeat`` numbered copies of each row."""
    return df.select(
        "*", ds(ts).alias("ds"), ds_add(ts, add_days).alias(f"ds_add_{add_days}"),
        F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))).alias("i"),
    )
