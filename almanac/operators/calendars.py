"""Slots of calendar schedules, and the slot that each row falls into."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.functions.cron import ONCE, Cron, parse_cron
from almanac.staging import stage


def _has_day(day: Column, cron: Cron) -> Column:
    in_month = F.dayofmonth(day).isin(*sorted(cron.days))
    in_week = (F.dayofweek(day) - 1).isin(*sorted(cron.weekdays))
    right = in_month & in_week if cron.any_day or cron.any_weekday else in_month | in_week
    return right & F.month(day).isin(*sorted(cron.months))


def calendar_days(spark: SparkSession, first: datetime, last: datetime, cron: Cron) -> DataFrame:
    """(day, latest): the days from ``first`` to ``last``, and the latest day up to each that has slots.

    ``first`` must have a slot.  One row for each day, so the running maximum is over a calendar, not over data.
    """
    days = spark.range((last.date() - first.date()).days + 1).select(
        F.date_add(F.lit(first.date().isoformat()).cast("date"), F.col("id").cast("int")).alias("day")
    )
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumn("latest", F.max(F.when(_has_day(F.col("day"), cron), F.col("day"))).over(upto))


def _instant(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def slot_at(day: Column, minute: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(mins=minute)


def with_slot(df: DataFrame, ts: str, cron: Cron, days: DataFrame, name: str = "slot") -> DataFrame:
    """Add the latest slot up to each row's time: the last fitting minute of its day, else the last one of an earlier day.

    ``days`` has the rows' days and the day before the first.
    """
    minutes = F.array(*map(F.lit, cron.minutes))
    time = F.col(ts).cast("timestamp_ntz")
    known = df.withColumn("__day", F.to_date(time)).withColumn("__minute", F.hour(time) * 60 + F.minute(time))
    earlier = days.select(F.date_add("day", 1).alias("__next"), F.col("latest").alias("__earlier"))
    today = days.select(F.col("day").alias("__day"), (F.col("latest") == F.col("day")).alias("__today"))
    # Minutes are in order, so those up to the row's are the first ones.
    fitting = F.size(F.filter(minutes, lambda m: m <= F.col("__minute")))
    placed = known.join(today, "__day").join(earlier, F.col("__day") == F.col("__next"), "left")
    in_day = F.coalesce(F.col("__today"), F.lit(False)) & (fitting > 0)
    slot = F.when(in_day, slot_at(F.col("__day"), F.get(minutes, fitting - 1))).otherwise(
        slot_at(F.col("__earlier"), F.lit(cron.minutes[-1]))
    )
    return placed.withColumn(name, slot).drop("__day", "__minute", "__next", "__earlier", "__today")


def schedule_slots(
    df: DataFrame, ts: str, schedule: str, counted: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """(slot, n): non-NULL ``counted`` values in each slot from ``start`` to ``end``, with 0 for empty slots.

    A row belongs to the latest slot up to its time.  The bounds default to the data's own; rows outside them, and
    rows before the very first slot, do not count.  ``@once`` is one slot at ``start``.  Days and minutes of the
    calendar are made by all tasks; rows are counted for each slot before they meet it.
    """
    times = df.withColumn(ts, F.col(ts).cast("timestamp_ntz")).where(F.col(ts).isNotNull())
    least, most = times.agg(F.min(ts), F.max(ts)).first()
    first, last = start or least, end or most
    if first is None or last is None or first > last:
        return df.sparkSession.createDataFrame([], "slot timestamp_ntz, n bigint")
    cron = None if schedule == ONCE else parse_cron(schedule)
    first = first if cron is None else cron.last_slot(first) or first
    inside = times.where(F.col(ts).between(_instant(first), _instant(last)))
    if cron is None:
        return inside.agg(F.count(counted).alias("n")).select(_instant(first).alias("slot"), "n")
    days = stage(calendar_days(df.sparkSession, first, last, cron), "calendar-days")
    counts = with_slot(inside, ts, cron, days).groupBy("slot").agg(F.count(counted).alias("n"))
    slots = (
        days.where(F.col("latest") == F.col("day"))
        .select("day", F.explode(F.array(*map(F.lit, cron.minutes))).alias("minute"))
        .select(slot_at(F.col("day"), F.col("minute")).alias("slot"))
        .where(F.col("slot").between(_instant(first), _instant(last)))
    )
    return slots.join(counts, "slot", "left").select("slot", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
