import os

from pyspark.sql import types as T

from almanac.streaming.listener import deliver, listen


def drop_files(tmp_path, names):
    inbox = tmp_path / "inbox"
    inbox.mkdir(exist_ok=True)
    for name in names:
        (inbox / name).write_text(f"content of {name}\n")
    return str(inbox)


def run(spark, tmp_path, stream):
    query = deliver(stream, str(tmp_path / "sink"), str(tmp_path / "checkpoint"), every=None)
    query.awaitTermination()
    return query


def delivered(spark, tmp_path):
    return sorted((r.file_name, r.value) for r in spark.read.parquet(str(tmp_path / "sink")).collect())


def test_takes_one_file_at_a_time_and_delivers_all(spark, tmp_path):
    names = ["a.txt", "b.txt", "c.txt"]
    inbox = drop_files(tmp_path, names)
    query = run(spark, tmp_path, listen(spark, inbox, str(tmp_path / "archive")))
    assert delivered(spark, tmp_path) == [(n, f"content of {n}") for n in names]
    assert max(p.numInputRows for p in query.recentProgress) == 1


def test_restart_delivers_only_new_files(spark, tmp_path):
    inbox = drop_files(tmp_path, ["a.txt"])
    run(spark, tmp_path, listen(spark, inbox))
    drop_files(tmp_path, ["b.txt"])
    run(spark, tmp_path, listen(spark, inbox))
    run(spark, tmp_path, listen(spark, inbox))
    assert [n for n, _ in delivered(spark, tmp_path)] == ["a.txt", "b.txt"]


def test_nothing_lost_between_inbox_and_archive(spark, tmp_path):
    names = [f"{i}.txt" for i in range(4)]
    inbox = drop_files(tmp_path, names)
    run(spark, tmp_path, listen(spark, inbox, str(tmp_path / "archive")))
    left = set(os.listdir(inbox))
    moved = {f for _, _, found in os.walk(tmp_path / "archive") for f in found}
    assert left | moved >= set(names)
    assert not left & moved


def test_empty_directory_does_nothing(spark, tmp_path):
    inbox = drop_files(tmp_path, [])
    query = run(spark, tmp_path, listen(spark, inbox))
    assert sum(p.numInputRows for p in query.recentProgress) == 0


def test_typed_files(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "x.csv").write_text("1,a\n2,b\n")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())])
    run(spark, tmp_path, listen(spark, str(inbox), schema=schema, fmt="csv"))
    got = spark.read.parquet(str(tmp_path / "sink")).collect()
    assert sorted((r.n, r.s, r.file_name) for r in got) == [(1, "a", "x.csv"), (2, "b", "x.csv")]
