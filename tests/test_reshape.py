import datetime as dt

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from almanac.operators import reshape


def test_concat_takes_the_first_tables_order_and_fills_nulls(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2, 3.0)], "b string, a int, c double")
    both = reshape.concat_tables(a, b, a)
    assert both.columns == ["a", "b", "c"]
    assert sorted(tuple(r) for r in both.where("c is null").collect()) == [(1, "x", None), (1, "x", None)]
    assert both.where("c = 3.0").first().a == 2


def test_parse_date_is_strict(spark):
    df = spark.createDataFrame([("2024-02-29",), (None,)], "d string")
    assert [r.d for r in reshape.parse_date(df, "d").collect()] == [dt.date(2024, 2, 29), None]
    with pytest.raises(Exception, match="not a date in column d: junk"):
        reshape.parse_date(spark.createDataFrame([("junk",)], "d string"), "d").collect()


def test_parse_date_with_another_format(spark):
    df = spark.createDataFrame([("20240131",)], "d string")
    assert reshape.parse_date(df, "d", "yyyyMMdd", into="day").first().day == dt.date(2024, 1, 31)


def test_split_by_date_loses_no_row(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-30"), (3, "junk"), (4, None)], "id int, d string")
    good, bad = reshape.split_by_date(df, "d")
    assert sorted(r.id for r in good.collect()) == [1, 4]
    assert sorted((r.id, r.d) for r in bad.collect()) == [(2, "2024-02-30"), (3, "junk")]


def test_day_of_year_and_sql_stage(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 31),), (dt.date(2023, 12, 31),)], "date date")
    assert sorted(r.day_of_year for r in reshape.day_of_year(df).collect()) == [365, 366]
    got = reshape.sql_over(df, "SELECT max(dayofyear(date)) AS m FROM __THIS__")
    assert got.first().m == 366


def test_first_rows_sorts_per_task(spark):
    got = reshape.first_rows(spark.range(100).repartition(4), ["id"], 5)
    assert [r.id for r in got.collect()] == [0, 1, 2, 3, 4]
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()


def test_flatten_and_columns_round_trip(spark):
    image = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, 4.0]])], "id int, m array<array<double>>")
    flat = image.select("id", reshape.flatten_nested("m").alias("x"))
    wide = reshape.array_to_columns(flat, "x", 4)
    assert tuple(wide.first()) == (1, 1.0, 2.0, 3.0, 4.0)
    back = reshape.columns_to_array(wide, ["p0", "p1", "p2", "p3"], "x")
    assert back.first().x == [1.0, 2.0, 3.0, 4.0]


def test_array_of_another_width_is_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "id int, x array<double>")
    with pytest.raises(Exception, match="expected 2 elements, got 3"):
        reshape.array_to_columns(df, "x", 2).collect()


def test_assemble_rejects_or_skips_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "a int, b double")
    with pytest.raises(Exception):
        reshape.assemble_features(df, ["a", "b"]).collect()
    kept = reshape.assemble_features(df, ["a", "b"], invalid="skip").select(vector_to_array("features").alias("f"))
    assert [r.f for r in kept.collect()] == [[1.0, 2.0]]
    assert reshape.assemble_features(df, ["a", "b"], invalid="keep").count() == 2


def test_reshape_needs_no_shuffle(spark):
    df = spark.range(10).select("id", F.array(F.col("id").cast("double")).alias("x"))
    assert "Exchange" not in reshape.array_to_columns(df, "x", 1)._jdf.queryExecution().toString()
