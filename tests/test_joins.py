import datetime as dt

from pyspark.sql import functions as F

from almanac.operators.joins import align_on_key, yesterday_join


def days(spark, rows):
    return spark.createDataFrame(
        [(s, dt.date(2024, 1, d) if d else None, v) for s, d, v in rows], "station string, date date, tmax double"
    )


def test_yesterday_skips_gaps_and_stations(spark):
    daily = days(spark, [("A", 1, 1.0), ("A", 2, 2.0), ("A", 4, 4.0), ("B", 3, 9.0)])
    got = yesterday_join(daily).collect()
    assert [(r.station, r.date.day, r.tmax, r.yesterday_tmax) for r in got] == [("A", 2, 2.0, 1.0)]


def test_yesterday_multiplies_duplicate_days(spark):
    daily = days(spark, [("A", 1, 1.0), ("A", 1, 1.5), ("A", 2, 2.0)])
    assert sorted(r.yesterday_tmax for r in yesterday_join(daily).collect()) == [1.0, 1.5]


def test_yesterday_keeps_null_values_and_drops_null_keys(spark):
    daily = days(spark, [("A", 1, None), ("A", 2, None), (None, 2, 1.0), (None, 1, 1.0), ("A", None, 1.0)])
    got = yesterday_join(daily).collect()
    assert [(r.station, r.date.day, r.tmax, r.yesterday_tmax) for r in got] == [("A", 2, None, None)]


def test_yesterday_crosses_month_and_leap_day(spark):
    rows = [("A", dt.date(2024, 2, 29), 1.0), ("A", dt.date(2024, 3, 1), 2.0)]
    daily = spark.createDataFrame(rows, "station string, date date, tmax double")
    assert yesterday_join(daily).first().yesterday_tmax == 1.0


def test_yesterday_shuffles_its_input_once(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    daily = events.groupBy(F.col("user_id").alias("station"), F.col("ts").cast("date").alias("date")).agg(
        F.max("value").alias("tmax")
    )
    joined = yesterday_join(daily)
    joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final


def test_align_pairs_by_key_not_by_position(spark):
    x = spark.createDataFrame([(2, "x2"), (1, "x1"), (3, "x3")], "id int, x string")
    y = spark.createDataFrame([(1, "y1"), (2, "y2")], "id int, y string")
    assert sorted((r.id, r.x, r.y) for r in align_on_key(x, y, "id").collect()) == [(1, "x1", "y1"), (2, "x2", "y2")]

