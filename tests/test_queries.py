"""Every registered query against its SQL, and rows from those that have none."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract
from almanac.plans.catalog import QUERIES
from almanac.plans.oracle import ORACLE as SQL

SF = "/root/testdata/sf0.001"
UNCHECKED = sorted(set(QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, SQL[name]) == []


@pytest.mark.parametrize("name", UNCHECKED)
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_only_fitted_values_go_without_sql():
    assert UNCHECKED == [
        "l1_classifier", "l1_hinge_classifier", "linear_svc_classifier", "mlp_classifier", "saga_classifier", "saga_optimality",
        "score_models", "stochastic_hinge_classifier",
    ]


def test_all_of_them_are_registered():
    assert QUERIES.items() <= contract.queries().items()
    assert SQL.items() <= contract.oracle_sql().items()


def test_appending_leaves_no_table_behind(spark):
    before = spark.catalog.listTables()
    assert QUERIES["append_rows"](spark, SF).count() > 0
    assert spark.catalog.listTables() == before


def test_entry_has_a_stable_schema(spark):
    assert contract.entry(spark).columns == ["station", "date", "tmax", "yesterday_tmax"]
