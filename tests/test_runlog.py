import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from almanac.operators import runlog


def log(spark, rows):
    return spark.createDataFrame(
        [(k, i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), s) for k, i, m, s in rows],
        "k string, id int, ts timestamp_ntz, state string",
    )


@pytest.mark.parametrize(
    "states, all_success, one_success, all_done",
    [
        (("success", "success"), True, True, True),
        (("success", "skipped"), False, True, True),
        (("success", "failed"), False, True, True),
        (("skipped", "skipped"), False, False, True),
        (("failed", "skipped"), False, False, True),
        (("success", "running"), False, True, False),
        (("success", None), False, True, False),
        ((None, None), False, False, False),
    ],
)
def test_trigger_rules(spark, states, all_success, one_success, all_done):
    runs = spark.createDataFrame([("r", s) for s in states], "run string, state string")
    got = runlog.trigger_rules(runs, ["run"]).first()
    assert (got.all_success, got.one_success, got.all_done, got.n) == (all_success, one_success, all_done, 2)


def test_depends_on_past_against_brute_force(spark):
    rng = random.Random(1)
    states = ["success"] * 6 + ["skipped", "failed"]
    # One key has most of the rows, one key is NULL, and instants repeat.
    rows = [
        (rng.choice(["hot", "hot", "hot", "a", "b", "c", None]), i, rng.randrange(200), rng.choice(states))
        for i in range(600)
    ]
    got = runlog.depends_on_past(log(spark, rows), "k", ["ts", "id"]).collect()
    expected = {
        i: not any(k2 == k and s2 == "failed" and (m2, i2) < (m, i) for k2, i2, m2, s2 in rows)
        for k, i, m, _ in rows
    }
    assert {r.id: r.eligible for r in got} == expected
    assert len(got) == len(rows)
    assert 0 < sum(expected.values()) < len(rows)


def test_a_failed_run_is_itself_eligible(spark):
    got = runlog.depends_on_past(log(spark, [("a", 1, 0, "failed"), ("a", 2, 1, "success")]), "k", ["ts", "id"])
    assert {r.id: r.eligible for r in got.collect()} == {1: True, 2: False}


def test_latest_only_keeps_the_last_interval(spark):
    runs = log(spark, [("a", 1, 0, "x"), ("a", 2, 239, "x"), ("a", 3, 240, "x"), ("a", 4, 300, "x")])
    assert sorted(r.id for r in runlog.latest_only(runs, "ts", "4 hours").collect()) == [3, 4]


def slots(df):
    return [(r.slot.hour * 60 + r.slot.minute + 1440 * (r.slot.day - 1), r.n) for r in df.orderBy("slot").collect()]


def test_grid_fills_gaps(spark):
    runs = log(spark, [("a", 1, 3, "x"), ("a", 2, 4, "x"), ("a", 3, 35, "x")])
    assert slots(runlog.schedule_grid(runs, "ts", "10 minutes", "id")) == [(0, 2), (10, 0), (20, 0), (30, 1)]


def test_grid_and_latest_take_schedules(spark):
    runs = log(spark, [("a", 1, 3, "x"), ("a", 2, 1500, "x")])
    assert slots(runlog.schedule_grid(runs, "ts", "@daily", "id")) == [(0, 1), (1440, 1)]
    assert slots(runlog.schedule_grid(runs, "ts", dt.timedelta(hours=12), "id")) == [(0, 1), (720, 0), (1440, 1)]
    assert [r.id for r in runlog.latest_only(runs, "ts", "0 0 * * *").collect()] == [2]


def test_grid_reaches_stated_bounds_and_stops_there(spark):
    runs = log(spark, [("a", 1, 3, "x"), ("a", 2, 25, "x"), ("a", 3, 75, "x")])
    got = runlog.schedule_grid(
        runs, "ts", "10 minutes", "id", start="2024-01-01 00:12:00", end="2024-01-01 00:40:00"
    )
    assert slots(got) == [(10, 0), (20, 1), (30, 0), (40, 0)]


def test_grid_outside_the_data_is_all_zero(spark):
    runs = log(spark, [("a", 1, 3, "x")])
    got = runlog.schedule_grid(runs, "ts", "1 day", "id", start="2024-01-03", end="2024-01-05")
    assert slots(got) == [(2880, 0), (4320, 0), (5760, 0)]


def test_grid_without_catchup_is_the_last_slot(spark):
    runs = log(spark, [("a", 1, 3, "x"), ("a", 2, 25, "x"), ("a", 3, 28, "x")])
    assert slots(runlog.schedule_grid(runs, "ts", "10 minutes", "id", catchup=False)) == [(20, 2)]
    got = runlog.schedule_grid(runs, "ts", "10 minutes", "id", catchup=False, end="2024-01-01 00:59:00")
    assert slots(got) == [(50, 0)]


def test_grid_has_equal_days_where_clocks_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        runs = spark.sql(
            "SELECT explode(array(timestamp'2024-03-09 12:00:00', timestamp'2024-03-12 01:00:00')) AS ts, 1 AS id"
        )
        got = runlog.schedule_grid(runs, "ts", "1 day", "id").orderBy("slot").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [(r.slot.day, r.slot.hour, r.n) for r in got] == [(9, 0, 1), (10, 0, 0), (11, 0, 0), (12, 0, 1)]


def test_grid_of_nothing(spark):
    assert slots(runlog.schedule_grid(log(spark, []), "ts", "1 hour", "id")) == []


def test_latest_message_per_key_with_list_and_map_values(spark):
    rows = [("p", 1, [0], None), ("p", 2, [1, 2, 3], None), ("q", 2, None, {"a": "b"}), ("q", 1, None, {"z": "y"})]
    messages = spark.createDataFrame(rows, "task string, n int, items array<int>, pairs map<string,string>")
    got = {r.task: r for r in runlog.latest_per_key(messages, "task", ["n"], ["items", "pairs"]).collect()}
    assert got["p"]["items"] == [1, 2, 3] and got["p"].pairs is None
    assert got["q"].pairs == {"a": "b"} and got["q"]["items"] is None


def test_date_macros_cross_the_year(spark):
    row = spark.createDataFrame([(dt.datetime(2023, 12, 28, 23, 59),)], "ts timestamp_ntz")
    got = runlog.date_macros(row, "ts").orderBy("i").collect()
    assert [(r.ds, r.ds_add_7, r.i) for r in got] == [("2023-12-28", "2024-01-04", i) for i in range(5)]


def test_aggregates_combine_before_the_shuffle(spark):
    runs = spark.range(1000).select((F.col("id") % 2).alias("run"), F.lit("success").alias("state"))
    plan = runlog.trigger_rules(runs, ["run"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_a_long_calendar_is_made_by_many_tasks_in_runs(spark):
    runs = log(spark, [("a", 1, 0, "x"), ("a", 2, 2 * 24 * 60, "x")])
    grid = runlog.schedule_grid(runs, "ts", "1 second", "id")
    assert grid.count() == 2 * 86400 + 1
    assert grid.agg(F.sum("n"), F.countDistinct("slot")).first() == (2, 2 * 86400 + 1)
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_seventy_years_of_seconds_can_be_planned(spark):
    runs = log(spark, [("a", 1, 0, "x"), ("a", 2, 70 * 365 * 24 * 60, "x")])
    grid = runlog.schedule_grid(runs, "ts", "1 second", "id")
    assert grid.limit(5).count() == 5


def test_grid_of_no_rows_is_empty(spark):
    assert runlog.schedule_grid(log(spark, []).limit(0), "ts", "1 hour", "id").collect() == []


def test_depends_on_past_reads_its_input_twice(spark):
    runs = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn(
        "state", F.when(F.col("event_type") == "error", "failed").otherwise("success")
    )
    plan = runlog.depends_on_past(runs, "user_id", ["ts", "event_id"])._jdf.queryExecution().executedPlan().toString()
    # The log itself and the first failures, which are written by one more scan of the log.
    assert plan.count("FileScan") == 2
    assert "Window" not in plan
