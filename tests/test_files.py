import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import types as T

from almanac.operators.reshape import array_to_columns
from almanac.sinks.files import write_csv
from almanac.sources import files
from almanac.sources.tables import partitioned_read


def station_lines(station, skipped=(), doubled=()):
    lines = []
    for day in range(1, 21):
        if day in skipped:
            continue
        line = f"{station},2024-01-{day:02d},49.5,-123.25,12.0,{day / 2}\n"
        lines += [line, line] if day in doubled else [line]
    return lines


@pytest.fixture
def weather_dir(tmp_path):
    for station, gaps, twice in (("ST0", (7,), ()), ("ST1", (), (9,))):
        with gzip.open(tmp_path / f"{station}.csv.gz", "wt") as out:
            out.writelines(station_lines(station, gaps, twice))
    return str(tmp_path)


def test_gzip_directory_reads_as_one_typed_table(spark, weather_dir):
    df = files.read_station_csv(spark, weather_dir)
    assert df.schema == files.STATION_SCHEMA
    assert df.count() == 19 + 21
    first = df.where("station = 'ST0' and date = date'2024-01-03'").first()
    assert (first.latitude, first.longitude, first.elevation, first.tmax) == (49.5, -123.25, 12.0, 1.5)


def test_gzip_files_are_one_task_each_unless_spread(spark, weather_dir):
    assert files.read_station_csv(spark, weather_dir).rdd.getNumPartitions() <= 2
    assert files.read_station_csv(spark, weather_dir, partitions=5).rdd.getNumPartitions() == 5


def test_bad_date_fails_the_read(spark, tmp_path):
    (tmp_path / "x.csv").write_text("ST0,junk,1,2,3,4\n")
    with pytest.raises(Exception):
        files.read_station_csv(spark, str(tmp_path)).collect()


def test_leading_index_column_raises_instead_of_shifting(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        ",station,date,latitude,longitude,elevation,tmax\n0,ST0,2024-01-01,49.5,-123.25,100.0,7.5\n"
    )
    with pytest.raises(Exception, match="(?i)header"):
        files.read_typed_csv(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="(?i)header"):
        files.read_typed_csv(spark, str(tmp_path)).select("station").collect()


def test_header_in_another_order_raises(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        "date,station,latitude,longitude,elevation,tmax\n2024-01-01,ST0,49.5,-123.25,100.0,7.5\n"
    )
    with pytest.raises(Exception, match="(?i)header"):
        files.read_typed_csv(spark, str(tmp_path)).collect()


def test_written_csv_reads_back(spark, weather_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("csv") / "out")
    df = files.read_station_csv(spark, weather_dir)
    write_csv(df, out)
    assert sorted(files.read_typed_csv(spark, out).collect()) == sorted(df.collect())
    with pytest.raises(Exception, match="(?i)exists"):
        write_csv(df, out)


def test_csv_with_index_numbers_rows_in_order(spark, folder):
    out = os.path.join(folder, "out")
    write_csv(spark.range(50, 0, -1).repartition(4), out, index_by=["id"])
    schema = T.StructType([T.StructField("idx", T.LongType()), T.StructField("id", T.LongType())])
    got = files.read_typed_csv(spark, out, schema).collect()
    assert sorted((r.idx, r.id) for r in got) == [(i, i + 1) for i in range(50)]


def test_row_id_of_a_matrix_file_never_becomes_a_feature(spark, folder):
    out = os.path.join(folder, "out")
    samples = spark.createDataFrame([(9, 1, [0.5, 1.5, 2.5]), (8, 0, [1.0, 2.0, 3.0])], "id long, label int, x array<double>")
    write_csv(array_to_columns(samples, "x", 3), out)
    got = files.read_matrix_csv(spark, out, 3, samples.select("id", "label").schema)
    assert sorted((r.id, r.label, r.features) for r in got.collect()) == [(8, 0, [1.0, 2.0, 3.0]), (9, 1, [0.5, 1.5, 2.5])]


def test_inventory_lists_names_and_lengths(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("12345")
    (tmp_path / "sub" / "b.txt").write_text("1")
    listed = files.file_inventory(spark, str(tmp_path))
    got = {os.path.basename(r.path): (r.length, type(r.modificationTime)) for r in listed.collect()}
    assert got == {"a.txt": (5, dt.datetime), "b.txt": (1, dt.datetime)}
    assert "content" not in listed.columns


def test_jdbc_ranges():
    assert partitioned_read("id", 0, 100, 8) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"
    }
    with pytest.raises(ValueError):
        partitioned_read("id", 5, 5, 8)
