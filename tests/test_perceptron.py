"""The perceptron on packed rows against Spark's own, and fits side by side."""

import threading

import numpy as np
import pytest
from pyspark.ml import Estimator
from pyspark.sql import functions as F

from almanac.models import classifiers
from almanac.models.lbfgs import minimise
from almanac.plans import catalog


@pytest.fixture(scope="module")
def scaled(spark):
    random = np.random.default_rng(3)
    rows = [(random.normal(size=5).tolist(), int(i % 3)) for i in range(700)]
    df = spark.createDataFrame(rows, "scaled array<double>, label int").repartition(3)
    return classifiers.with_vector(df, "scaled").withColumn("label", F.col("label").cast("double")).cache()


@pytest.mark.parametrize("layers", [[5, 4, 3], [5, 3], [5, 4, 6, 3]], ids=["hidden", "none", "two"])
def test_packed_rows_take_the_steps_of_sparks_trainer(scaled, layers):
    """Blocks of 128 rows: the last one of each partition is short, and its rows weigh more."""
    own = classifiers.packed_perceptron(layers, max_iter=12).fit(scaled)
    theirs = classifiers.perceptron(layers, max_iter=12).fit(scaled)
    assert classifiers.steps_taken(own) == classifiers.steps_taken(theirs)
    np.testing.assert_allclose(own.weights.toArray(), theirs.weights.toArray(), rtol=1e-8, atol=1e-8)
    assert own.getMaxIter() == 12 and type(own) is type(theirs)


def test_packed_rows_end_by_the_same_tolerance(scaled):
    made = [make([5, 3]).fit(scaled) for make in (classifiers.packed_perceptron, classifiers.perceptron)]
    own, theirs = (classifiers.steps_taken(model)[0] for model in made)
    assert own == theirs < classifiers.MOST_STEPS


def test_the_search_finds_a_minimum_past_points_without_a_value():
    def objective(x):
        value = float("nan") if x[0] < -3 else float((x[0] - 1) ** 2 + 10 * (x[1] + 2) ** 2)
        return value, np.array([2 * (x[0] - 1), 20 * (x[1] + 2)])

    x, steps = minimise(objective, np.array([0.0, 5.0]), 1e-12, 100)
    assert 0 < steps < 100
    np.testing.assert_allclose(x, [1, -2], atol=1e-4)
    assert minimise(objective, np.array([0.0, 5.0]), 1e-12, 0)[1] == 0


def test_classifier_rows_trains_on_packed_rows(spark, monkeypatch):
    """Before, each evaluation of the perceptron was a job of two stages over vectors of 128 rows."""
    chosen = {}
    monkeypatch.setattr(catalog.digits, "reload_check", lambda samples, estimators, folder, classes: chosen.update(estimators))
    catalog.QUERIES["classifier_rows"](spark, "/root/testdata/sf0.001")
    assert list(chosen) == ["l1_logistic", "l1_hinge", "linear_svc", "mlp"]
    theirs = catalog.estimators(catalog.vectors(spark, "/root/testdata/sf0.001"))["mlp"]
    own = chosen["mlp"]
    assert type(own).__name__ == "PackedPerceptron"
    for given in ("getLayers", "getMaxIter", "getTol", "getSeed", "getBlockSize"):
        assert getattr(own, given)() == getattr(theirs, given)()


def test_fits_run_side_by_side(spark):
    """Before, the second fit began when the first had ended."""
    both = threading.Barrier(2, timeout=60)

    class Meeting(Estimator):
        def getMaxIter(self):
            return classifiers.MOST_STEPS

        def _fit(self, rows):
            both.wait()
            return classifiers.l1_logistic().fit(rows)

    train = spark.createDataFrame([(i, [float(i % 3), float(i % 5)], i % 3) for i in range(60)], "id long, features array<double>, label int")
    assert list(classifiers.fit_models(train, {"a": Meeting(), "b": Meeting()})) == ["a", "b"]
