import datetime as dt

from pyspark.sql import functions as F

from almanac.operators import routing


def test_route_takes_the_first_branch_that_holds(spark):
    branches = {"small": F.col("id") < 2, "even": F.col("id") % 2 == 0}
    got = routing.route(spark.range(5), branches, "rest").orderBy("id").collect()
    assert [r.branch for r in got] == ["small", "small", "even", "rest", "even"]


def test_route_by_minute_parity(spark):
    rows = [(dt.datetime(2024, 1, 1, 5, m),) for m in (0, 1, 59)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = routing.route(df, {"even": routing.even_minute("ts")}, "odd").orderBy("ts").collect()
    assert [r.branch for r in got] == ["even", "odd", "odd"]


def test_random_branch_uses_all_options_and_its_seed(spark):
    options = ["a", "b", "c"]

    def drawn(seed, partitions):
        return sorted(tuple(r) for r in routing.random_branch(
            spark.range(3000).repartition(partitions), "id", options, seed).collect())

    assert drawn(1, 1) == drawn(1, 6)
    assert drawn(1, 1) != drawn(2, 1)
    counts = [sum(b == o for _, b in drawn(1, 1)) for o in options]
    assert min(counts) > 900


def test_gates(spark):
    data, empty = spark.range(3), spark.range(0)
    assert routing.gate_if(data, spark.range(1).select(F.lit(True))).count() == 3
    assert routing.gate_if(data, spark.range(1).select(F.lit(False))).count() == 0
    assert routing.gate_if(data, spark.range(1).select(F.lit(None).cast("boolean"))).count() == 0
    assert routing.gate_nonempty(data, empty).count() == 0
    assert routing.gate_nonempty(data, data).count() == 3


def test_gates_plan_no_join(spark):
    gated = routing.gate_if(spark.range(3), spark.range(9).agg(F.count("*") > 0))
    assert "Join" not in gated._jdf.queryExecution().executedPlan().toString()


def test_payload_only_where_flagged_and_escaped(spark):
    df = spark.createDataFrame([(True, 'say "hi"'), (False, "x"), (None, "y")], "flag boolean, text string")
    got = routing.trigger_payloads(df, F.col("flag"), "text").collect()
    assert [r.conf for r in got] == ['{"message":"say \\"hi\\""}']
