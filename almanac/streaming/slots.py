"""Counts of event time on a stream, with a table of the rows that came too late."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from almanac.functions.schedule import seconds_of, step_of
from almanac.streaming.listener import EVERY

# Parts of a slot that are counted side by side, so that a slot with most of the rows is no single task's.
PARTS = 16

# How often a slot without new rows is looked at, in milliseconds; it leaves the state once the watermark has passed it.
LOOK_MS = 60_000

EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"

_KEPT_AS_TEXT = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"}


def slot_second(ts: Column, every: str) -> Column:
    """Start of the slot that holds an instant, in seconds since the epoch."""
    seconds = seconds_of(every)
    return F.floor(F.unix_seconds(ts) / seconds).cast("bigint") * seconds


def _count_or_pass_on(step_ms: int, names: Sequence[str]):
    """Counts the rows of one part of a slot while the watermark has not passed the slot's end, else returns them."""

    def of_slot(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        second, part = key
        closed = second * 1000 + step_ms <= state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            if closed:
                state.remove()
            else:
                state.setTimeoutDuration(LOOK_MS)
            return
        rows = 0
        for frame in frames:
            if closed:
                late = frame[list(names)].copy()
                yield late.assign(slot_second=second, part=part, n=None)
            rows += len(frame)
        if not closed:
            total = rows + (state.get[0] if state.exists else 0)
            state.update((total,))
            state.setTimeoutDuration(LOOK_MS)
            counted = dict.fromkeys(names, [None]) | {"slot_second": [second], "part": [part], "n": [total]}
            yield pd.DataFrame(counted)

    return of_slot


def count_slots(
    stream: DataFrame, ts: str, every: str, delay: str, sink: str, late: str, checkpoint: str, trigger: str | None = EVERY
) -> StreamingQuery:
    """Count the rows of each slot of event time; rows of slots that are closed go to ``late``, whole.

    The watermark is the latest time of all batches before, less ``delay``; a slot is closed once its end is not after the
    watermark.  A slot's counts lie in the state store until then.  Each batch writes the new totals of the
    slots it has changed to a folder of its number below ``sink`` and its late rows to one below ``late``, so a batch that is run
    again overwrites what it wrote; :func:`slot_counts` and :func:`late_rows` read them.  Rows without a time are in neither.

    ``ts`` is a zoned timestamp.  The other columns are of atomic types, binary excepted, as they pass through Python as text.
    ``trigger=None`` takes all waiting files and ends.
    """
    every = step_of(every)
    odd = [name for name, kind in stream.dtypes if kind not in _KEPT_AS_TEXT and not kind.startswith("decimal")]
    if odd:
        raise TypeError(f"columns that cannot be kept as text: {odd}")
    if dict(stream.dtypes)[ts] != "timestamp":
        raise TypeError(f"{ts} is no zoned timestamp")
    names = [f"value_{i}" for i in range(len(stream.columns))]
    as_text = [F.col(f"`{c}`").cast("string").alias(name) for c, name in zip(stream.columns, names, strict=True)]
    keyed = stream.where(F.col(ts).isNotNull()).withWatermark(ts, delay).select(
        F.col(ts).alias("event_time"), slot_second(F.col(ts), every).alias("slot_second"),
        F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in stream.columns]), F.lit(PARTS)).cast("int").alias("part"), *as_text,
    )
    text = ", ".join(f"{name} string" for name in names)
    counted = keyed.groupBy("slot_second", "part").applyInPandasWithState(
        _count_or_pass_on(seconds_of(every) * 1000, names),
        f"{text}, slot_second bigint, part int, n bigint", "n bigint", "update", GroupStateTimeout.ProcessingTimeTimeout,
    )
    kinds = [F.col(name).cast(field.dataType).alias(field.name) for name, field in zip(names, stream.schema, strict=True)]

    def batch(rows: DataFrame, number: int) -> None:
        kept = rows.persist()
        try:
            kept.where("n IS NOT NULL").select("slot_second", "part", "n").write.mode("overwrite").parquet(f"{sink}/batch={number}")
            kept.where("n IS NULL").select(*kinds).write.mode("overwrite").parquet(f"{late}/batch={number}")
        finally:
            kept.unpersist()

    writer = counted.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint)
    if trigger is not None:
        return writer.trigger(processingTime=trigger).start()
    # Batches without rows only look at open slots again; a run over the waiting files would go on with them for ever.
    conf = stream.sparkSession.conf
    before = conf.get(EMPTY_BATCHES)
    conf.set(EMPTY_BATCHES, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.set(EMPTY_BATCHES, before)


def slot_counts(spark: SparkSession, sink: str) -> DataFrame:
    """(slot, n): the newest total of each slot that :func:`count_slots` has counted."""
    totals = spark.read.schema("slot_second bigint, part int, n bigint, batch bigint").parquet(sink)
    newest = totals.groupBy("slot_second", "part").agg(F.max_by("n", "batch").alias("n"))
    return newest.groupBy("slot_second").agg(F.sum("n").alias("n")).select(F.timestamp_seconds("slot_second").alias("slot"), "n")


def late_rows(spark: SparkSession, late: str) -> DataFrame:
    """The rows that came after their slot was closed."""
    return spark.read.option("basePath", late).parquet(late).drop("batch")
