import pytest
from pyspark.sql import functions as F

from almanac.operators.indexing import permuted, with_row_index
from almanac.operators.splits import exact_split, weighted_split


def ids(spark, n, partitions):
    return spark.range(n).withColumnRenamed("id", "key").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_index_counts_from_zero_in_order(spark, partitions):
    rows = ids(spark, 1000, partitions).withColumn("back", -F.col("key"))
    indexed = with_row_index(rows, ["back"]).collect()
    assert sorted((r.idx, r.key) for r in indexed) == [(i, 999 - i) for i in range(1000)]


def test_row_index_orders_by_several_columns_with_ties_in_the_first(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("a"), F.col("id").alias("b")).repartition(5)
    indexed = with_row_index(rows, ["a", "b"]).orderBy("idx").collect()
    assert [(r.a, r.b) for r in indexed] == sorted((i % 3, i) for i in range(300))


def test_row_index_survives_one_value_holding_most_rows_in_the_first_column(spark):
    rows = spark.range(500).select(F.when(F.col("id") < 400, 1).otherwise(2).alias("a"), F.col("id").alias("b"))
    indexed = with_row_index(rows, ["a", "b"])
    assert [r.idx for r in indexed.orderBy("a", "b").collect()] == list(range(500))


def test_row_index_of_nothing(spark):
    assert with_row_index(spark.range(0), ["id"]).collect() == []


def test_permutation_is_complete_seeded_and_independent_of_partitions(spark):
    def order(partitions, seed):
        rows = permuted(ids(spark, 500, partitions), "key", seed).orderBy("pos").collect()
        assert [r.pos for r in rows] == list(range(500))
        return [r.key for r in rows]

    assert order(1, 0) == order(7, 0)
    assert order(1, 0) != order(1, 1)
    assert order(1, 0) != list(range(500))


def test_permutation_keeps_features_and_label_together(spark):
    rows = spark.range(100).select("id", (F.col("id") * 2).alias("x"), (F.col("id") * 3).alias("y"))
    assert permuted(rows, "id", 0).where("x != id * 2 or y != id * 3").count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_split_has_exact_disjoint_parts_and_drops_the_rest(spark, partitions):
    parts = exact_split(ids(spark, 7, partitions), "key", 3, 2, seed=4).collect()
    train = {r.key for r in parts if r.part == "train"}
    test = {r.key for r in parts if r.part == "test"}
    assert (len(train), len(test), len(parts)) == (3, 2, 5)
    assert not train & test


def test_exact_split_does_not_depend_on_partitions(spark):
    one, seven = (exact_split(ids(spark, 200, p), "key", 0.5, 0.25, 4).collect() for p in (1, 7))
    assert sorted(one) == sorted(seven)
    assert sum(r.part == "train" for r in one) == 100
    assert sum(r.part == "test" for r in one) == 50


def test_exact_split_shares_round_down_and_up(spark):
    parts = [r.part for r in exact_split(ids(spark, 10, 2), "key", 0.25, 0.25, 0).collect()]
    assert (parts.count("train"), parts.count("test")) == (2, 3)


def test_exact_split_rejects_more_rows_than_there_are(spark):
    with pytest.raises(Exception, match="exceeds the number of rows"):
        exact_split(ids(spark, 4, 2), "key", 3, 2, seed=0).collect()
    assert exact_split(ids(spark, 5, 2), "key", 3, 2, seed=0).count() == 5


def test_weighted_split_is_near_its_weights_and_independent_of_partitions(spark):
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    one, seven = (weighted_split(ids(spark, 5000, p), "key", weights, 3).collect() for p in (1, 7))
    assert sorted(one) == sorted(seven)
    for part, weight in weights.items():
        assert abs(sum(r.part == part for r in one) / 5000 - weight) < 0.03


def test_weighted_split_plans_no_shuffle(spark):
    plan = weighted_split(spark.range(10), "id", {"train": 3, "rest": 1}, 0)._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_a_row_without_an_id_is_an_error(spark):
    rows = spark.createDataFrame([(1,), (None,)], "key long")
    for run in (lambda: permuted(rows, "key", seed=0), lambda: exact_split(rows, "key", 1, 1, seed=0)):
        with pytest.raises(Exception, match="NULL in id column key"):
            run().collect()
