from datetime import datetime, timedelta, timezone

import pytest

from almanac.streaming import slots

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
SCHEMA = "id bigint, at timestamp, amount double, label string"


def drop(spark, folder, rows):
    made = [(i, None if hours is None else START + timedelta(hours=hours), amount, label) for i, hours, amount, label in rows]
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/inbox")


def run(spark, folder, delay="2 hours"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 100).parquet(f"{folder}/inbox")
    slots.count_slots(
        stream, "at", "1 hour", delay, f"{folder}/sink", f"{folder}/late", f"{folder}/checkpoint", trigger=None
    ).awaitTermination()


def counts(spark, folder):
    found = slots.slot_counts(spark, f"{folder}/sink").selectExpr("unix_seconds(slot) AS s", "n").collect()
    return {(r.s - int(START.timestamp())) // 3600: r.n for r in found}


def late(spark, folder):
    return sorted((r.id, r.amount, r.label) for r in slots.late_rows(spark, f"{folder}/late").collect())


def test_rows_of_closed_slots_go_to_the_late_table(spark, folder):
    drop(spark, folder, [(1, 0.1, 1.5, "a"), (2, 0.2, None, None), (3, 5.0, 2.0, "b"), (4, None, 1.0, "no time")])
    run(spark, folder)
    assert counts(spark, folder) == {0: 2, 5: 1} and late(spark, folder) == []
    # The watermark is 3:00 now: slots 0 to 2 are closed, also for a row whose time is the last of slot 2.
    drop(spark, folder, [(5, 0.5, 0.1, "late"), (6, 2.999, None, None), (7, 3.0, 1.0, "open"), (8, 5.5, 1.0, "open")])
    run(spark, folder)
    assert counts(spark, folder) == {0: 2, 3: 1, 5: 2}
    assert late(spark, folder) == [(5, 0.1, "late"), (6, None, None)]
    read = slots.late_rows(spark, f"{folder}/late")
    assert read.dtypes == [("id", "bigint"), ("at", "timestamp"), ("amount", "double"), ("label", "string")]


def test_many_rows_of_one_slot_are_counted_by_several_parts(spark, folder):
    drop(spark, folder, [(i, 0.5, float(i), "x") for i in range(2000)] + [(9999, 30.0, 0.0, "y")])
    run(spark, folder)
    parts = spark.read.parquet(f"{folder}/sink").where("n IS NOT NULL").select("slot_second", "part").distinct().count()
    assert counts(spark, folder) == {0: 2000, 30: 1} and parts == slots.PARTS + 1
    drop(spark, folder, [(i, 0.6, float(i), "x") for i in range(100)])
    run(spark, folder)
    assert counts(spark, folder) == {0: 2000, 30: 1} and len(late(spark, folder)) == 100


def test_a_batch_that_fails_is_run_again_without_counting_twice(spark, folder, monkeypatch):
    drop(spark, folder, [(1, 0.1, 1.0, "a"), (2, 9.0, 1.0, "a")])
    run(spark, folder)
    drop(spark, folder, [(3, 0.2, 1.0, "late"), (4, 9.1, 1.0, "a")])
    classic = type(spark.range(1))
    kept = classic.unpersist

    def failing(frame, *arguments):
        kept(frame, *arguments)
        raise RuntimeError("the machine is gone")

    # Both tables of the batch are written when it fails.
    monkeypatch.setattr(classic, "unpersist", failing)
    with pytest.raises(Exception, match="the machine is gone"):
        run(spark, folder)
    monkeypatch.undo()
    run(spark, folder)
    assert counts(spark, folder) == {0: 1, 9: 2} and [r[0] for r in late(spark, folder)] == [3]


def test_columns_that_text_cannot_keep_are_refused(spark, folder):
    frame = spark.createDataFrame([], "at timestamp, raw binary")
    with pytest.raises(TypeError, match="raw"):
        slots.count_slots(frame, "at", "1 hour", "1 hour", folder, folder, folder)
    with pytest.raises(TypeError, match="no zoned timestamp"):
        slots.count_slots(spark.createDataFrame([], "at timestamp_ntz"), "at", "1 hour", "1 hour", folder, folder, folder)
