import os
import subprocess
import sys
from types import SimpleNamespace

from pyspark.sql import functions as F

from almanac import staging


def fake(conf=None, checkpoint=None, master="local[2]"):
    context = SimpleNamespace(getCheckpointDir=lambda: checkpoint, master=master, applicationId="app-" + master)
    settings = {"spark.sql.warehouse.dir": "file:/warehouse", **(conf or {})}
    return SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    )


def test_the_sessions_folder_comes_first():
    named = {"spark.checkpoint.dir": "hdfs://shared"}
    assert staging.staging_root(fake(named, "hdfs://other", "yarn")) == "hdfs://shared"
    assert staging.staging_root(fake(None, "hdfs://other", "yarn")) == "hdfs://other"


def test_a_plain_session_uses_its_warehouse_whatever_the_master():
    for master in ("local[2]", "spark://host:7077"):
        assert staging.staging_root(fake(master=master)) == "file:/warehouse"


def test_stage_writes_below_the_folder_and_keeps_the_schema(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    staged = staging.stage(df, "label")
    assert staged.schema["x"].dataType == df.schema["x"].dataType
    below = f"{spark.conf.get('spark.checkpoint.dir')}/almanac/{spark.sparkContext.applicationId}/label-"
    assert all(below in f for f in staged.inputFiles())
    assert staged.count() == 10


def test_what_has_been_staged_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda session: str(tmp_path))
    staged = staging.stage(spark.range(5).select(F.col("id") * 2), "numbers")
    assert staged.count() == 5
    assert staging.clean(spark)
    assert not list(tmp_path.glob("almanac/*"))


def test_a_session_that_sets_nothing_can_run_every_kind_of_staging(tmp_path):
    """In a process of its own, since a session's folders cannot be changed."""
    code = """
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("row_index", "append_rows", "station_csv", "depends_on_past"):
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
from almanac import staging
assert staging.clean(spark)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr[-2000:]
