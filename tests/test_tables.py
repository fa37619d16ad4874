import datetime as dt
import uuid

import pytest

from almanac.sinks import tables

COLUMNS = list(tables.SINK_COLUMNS)
NOW = dt.datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture
def sink(spark, folder):
    name = "sink_" + uuid.uuid4().hex
    tables.create_table(spark, name, location=folder)
    yield name
    spark.sql(f"DROP TABLE {name}")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "custom_id int, timestamp timestamp_ntz, user_id string")


def test_create_twice_keeps_the_rows(spark, sink, folder):
    tables.append_rows(rows(spark, (1, NOW, "a")), sink, COLUMNS)
    tables.create_table(spark, sink, location=folder)
    assert [tuple(r) for r in spark.table(sink).collect()] == [(1, NOW, "a")]


def test_append_goes_by_name(spark, sink):
    tables.append_rows(rows(spark, (1, NOW, "a")).select("user_id", "custom_id", "timestamp"), sink, COLUMNS)
    assert [tuple(r) for r in spark.table(sink).collect()] == [(1, NOW, "a")]


@pytest.mark.parametrize("column", [0, 1, 2])
def test_null_in_any_column_is_rejected(spark, sink, column):
    row = [1, NOW, "a"]
    row[column] = None
    with pytest.raises(Exception, match=f"NULL in NOT NULL column {COLUMNS[column]}"):
        tables.append_rows(rows(spark, tuple(row)), sink, COLUMNS)
    assert spark.table(sink).count() == 0


def test_too_long_text_is_rejected(spark, sink):
    tables.append_rows(rows(spark, (1, NOW, "x" * 50)), sink, COLUMNS)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        tables.append_rows(rows(spark, (1, NOW, "x" * 51)), sink, COLUMNS)


def test_insert_binds_its_values(spark, sink):
    nasty = "a'); DROP TABLE x; --"
    tables.insert_row(spark, sink, [7, NOW, nasty])
    assert [tuple(r) for r in spark.table(sink).collect()] == [(7, NOW, nasty)]
    with pytest.raises(ValueError):
        tables.insert_row(spark, sink, [7, None, "x"])


def test_split_nulls_loses_no_row(spark):
    df = rows(spark, (1, NOW, "a"), (None, NOW, "b"), (3, None, None))
    good, bad = tables.split_nulls(df, COLUMNS)
    assert [r.custom_id for r in good.collect()] == [1]
    assert sorted(str(r.custom_id) for r in bad.collect()) == ["3", "None"]


def test_violations_are_counted_in_one_scan(spark):
    df = rows(spark, (1, NOW, "a"), (None, NOW, None), (3, None, None))
    got = tables.null_violations(df, COLUMNS, "t").collect()
    assert [(r.column_name, r.violations) for r in got] == [("custom_id", 1), ("timestamp", 1), ("user_id", 2)]


def test_names_and_places_are_quoted(spark, folder):
    assert tables.qualified("db.odd `name`") == "`db`.`odd ``name```"
    name, place = "sink_" + uuid.uuid4().hex, f"{folder}/it's"
    tables.create_table(spark, name, {"a b": "INT"}, location=place)
    try:
        tables.insert_row(spark, name, [1])
        assert [tuple(r) for r in spark.read.parquet(place).collect()] == [(1,)]
    finally:
        spark.sql(f"DROP TABLE {tables.qualified(name)}")
