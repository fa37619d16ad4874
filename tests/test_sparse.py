import pytest
from pyspark.sql import functions as F

from almanac.operators import scaling, sparse
from almanac.sources.files import read_sparse_csv

ROWS = [(1, [0.0, 2.0, 0.0, -1.5]), (2, [0.0, 0.0, 0.0, 3.0]), (3, [0.0, 4.0, -0.0, 1e9]), (4, None)]


@pytest.fixture(scope="module")
def dense(spark):
    return spark.createDataFrame(ROWS, "id bigint, x array<double>")


@pytest.fixture(scope="module")
def thin(dense):
    return dense.withColumn("x", sparse.to_sparse("x"))


def test_there_and_back(dense, thin):
    first, *_, last = thin.orderBy("id").collect()
    assert (first.x.width, first.x.places, first.x.numbers) == (4, [1, 3], [2.0, -1.5])
    assert last.x is None
    back = thin.select("id", sparse.to_dense("x").alias("x")).orderBy("id").collect()
    assert [(r.id, r.x) for r in back] == ROWS


def test_an_empty_vector(spark):
    row = spark.sql("SELECT CAST(array() AS array<double>) AS x").select(sparse.to_sparse("x").alias("x"))
    assert row.select("x.width", "x.places", sparse.to_dense("x").alias("back")).first() == (0, [], [])


def test_statistics_equal_those_of_dense_vectors(dense, thin):
    expected = {r.pos: (r["mean"], r["sd"]) for r in scaling.feature_stats(dense, "x").collect()}
    found = {r.pos: (r["mean"], r["sd"]) for r in sparse.sparse_feature_stats(thin, "x").collect()}
    assert found.keys() == expected.keys()
    for pos, values in expected.items():
        assert found[pos] == pytest.approx(values, rel=1e-12)
    assert found[0] == (0.0, 0.0)


def test_zero_share_counts_rows_with_a_vector(thin):
    assert {r.pos: r.zero_pct for r in sparse.sparse_zero_share(thin, "x").collect()} == {
        0: 100.0, 1: pytest.approx(33.333333), 2: 100.0, 3: 0.0,
    }


def test_products_equal_those_of_standardised_vectors(spark, dense, thin):
    weights = spark.createDataFrame([(0, 0.5), (1, -2.0), (2, 7.0), (3, 1.0)], "pos int, weight double")
    scaled = scaling.standardize(dense, "x", scaling.fit_scaler(dense, "x"))
    expected = {
        r.id: None if r.scaled is None else sum(w * z for w, z in zip((0.5, -2.0, 7.0, 1.0), r.scaled, strict=True)) for r in scaled.collect()
    }
    stats = sparse.sparse_feature_stats(thin, "x")
    found = {r.id: r["product"] for r in sparse.standardized_products(thin, "id", "x", stats, weights).collect()}
    assert found == {k: v if v is None else pytest.approx(v, rel=1e-9) for k, v in expected.items()}


def test_an_empty_table_has_no_statistics(thin):
    none = thin.where("id < 0")
    assert sparse.sparse_feature_stats(none, "x").collect() == []
    assert sparse.sparse_zero_share(none, "x").collect() == []


def test_null_elements_and_other_widths_are_errors(spark):
    holed = spark.createDataFrame([(1, [1.0, None])], "id bigint, x array<double>")
    with pytest.raises(Exception, match="null element"):
        holed.select(sparse.to_sparse("x")).collect()
    uneven = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id bigint, x array<double>")
    with pytest.raises(Exception, match="vectors of 1 and of 2 elements"):
        sparse.sparse_zero_share(uneven.withColumn("x", sparse.to_sparse("x")), "x").collect()


def test_only_what_is_not_zero_is_read_from_a_file(spark, folder):
    with open(f"{folder}/wide.csv", "w") as out:
        out.write("id,p0,p1,p2\n7,0,0.0,3\n8,0,0,0\n")
    keys = spark.createDataFrame([], "id bigint").schema
    rows = read_sparse_csv(spark, folder, 3, keys).orderBy("id").select("id", F.col("features.places"), F.col("features.numbers")).collect()
    assert [tuple(r) for r in rows] == [(7, [2], [3.0]), (8, [], [])]
