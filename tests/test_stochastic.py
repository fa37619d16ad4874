import numpy as np
import pytest

from almanac.models import classifiers
from almanac.models.hinge import L1Hinge
from almanac.models.stochastic import BATCH, FIRST_STEP, StochasticL1Hinge
from almanac.plans import digits

SF = "/root/testdata/sf0.01"
PENALTY = classifiers.L1_PENALTY


@pytest.fixture(scope="module")
def samples(spark):
    from almanac.plans.inputs import vectors

    return vectors(spark, SF)


@pytest.fixture(scope="module")
def train(samples):
    return digits.train_and_test(samples)[0].cache()


def scaled(train):
    rows = train.orderBy("id").collect()
    x = np.array([r["features"] for r in rows], dtype=float)
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    return np.hstack([x, np.ones((len(x), 1))]), np.array([r["label"] for r in rows])


def hinge_objective(weights, x, y):
    sign = np.where(y[:, None] == np.arange(len(weights)), 1.0, -1.0)
    short = np.clip(1.0 - sign * (x @ weights.T), 0.0, None)
    return np.where(short < 1, 0.5 * short**2, short - 0.5).sum() / len(x) + PENALTY * np.abs(weights[:, :-1]).sum()


def test_stochastic_hinge_reaches_the_objective_of_full_steps_in_half_the_passes(train):
    fitted = classifiers.fit_models(train, {"full": classifiers.l1_hinge(10), "stochastic": classifiers.stochastic_l1_hinge(10)})
    x, y = scaled(train)
    objective = {name: hinge_objective(model.stages[-1].matrix, x, y) for name, model in fitted.items()}
    assert objective["stochastic"] <= 1.01 * objective["full"]
    assert 2 * fitted["stochastic"].stages[-1].passes <= fitted["full"].stages[-1].passes
    assert (fitted["stochastic"].stages[-1].coefficient_rows == 0).mean() > 0.5


@pytest.mark.parametrize("make", [classifiers.stochastic_l1_hinge, classifiers.saga_l1_logistic], ids=["hinge", "saga"])
def test_coefficients_do_not_depend_on_partitions(train, make, monkeypatch):
    from almanac.models import stochastic

    monkeypatch.setattr(stochastic, "SHARD_ROWS", 150)
    matrices = [
        classifiers.fit_models(train.repartition(parts), {"m": make(10)})["m"].stages[-1].matrix for parts in (1, 6)
    ]
    assert abs(matrices[0] - matrices[1]).max() < 1e-9


def test_stochastic_hinge_equals_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(100, 3)), rng.integers(0, 3, 100)
    places = rng.permutation(100)
    rows = spark.createDataFrame(
        [(v.tolist(), float(k), int(p)) for v, k, p in zip(x, y, places, strict=True)], "f array<double>, label double, place long"
    )
    df = classifiers.with_vector(rows.withColumnRenamed("f", "features"))
    got = StochasticL1Hinge(numClasses=3, regParam=0.05, maxIter=3).fit(df).matrix
    order = [r["i"] for r in rows.selectExpr("place AS i", "xxhash64(0, place) AS h").orderBy("h").collect()]
    at = {int(p): i for i, p in enumerate(places)}
    x1, w = np.hstack([x, np.ones((100, 1))])[[at[p] for p in order]], np.zeros((3, 4))
    labels = y[[at[p] for p in order]]
    for done in range(3):
        rate, due, had = FIRST_STEP / 4 / (1 + done), 0.0, np.zeros((3, 3))
        for i in range(0, 100, BATCH):
            for k in range(3):
                gradient = np.zeros(4)
                for row, label in zip(x1[i : i + BATCH], labels[i : i + BATCH], strict=True):
                    sign = 1.0 if label == k else -1.0
                    gradient -= sign * min(max(1 - sign * (w_before := w if k == 0 else kept)[k] @ row, 0.0), 1.0) * row
                if k == 0:
                    kept = w.copy()
                w[k] -= rate * gradient / len(x1[i : i + BATCH])
            due += rate * 0.05
            for k in range(3):
                for j in range(3):
                    v = w[k, j]
                    z = max(0.0, v - (due + had[k, j])) if v > 0 else min(0.0, v + (due - had[k, j])) if v < 0 else 0.0
                    had[k, j] += z - v
                    w[k, j] = z
    assert abs(got - w).max() < 1e-9


def test_saga_meets_the_conditions_of_the_optimum(train):
    model = classifiers.fit_models(train, {"saga": classifiers.saga_l1_logistic(10)})["saga"]
    rows = classifiers.optimality(model, train).collect()
    assert len(rows) == 10 * 65 and max(r["gap"] for r in rows) < 1e-3
    assert any(r["value"] == 0 for r in rows) and any(r["value"] != 0 for r in rows)
    x, y = scaled(train)
    weights = model.stages[-1].matrix
    shares = np.exp(x @ weights.T)
    shares /= shares.sum(axis=1, keepdims=True)
    shares[np.arange(len(y)), y] -= 1
    gradient = shares.T @ x / len(x)
    for r in rows:
        assert r["gradient"] == pytest.approx(gradient[r["class"], r["feature"]], abs=1e-9)


def test_unusable_rows_are_errors(spark):
    empty = classifiers.with_vector(spark.createDataFrame([], "features array<double>, label double"))
    with pytest.raises(ValueError, match="no training rows"):
        StochasticL1Hinge(numClasses=2).fit(empty)
    one = classifiers.with_vector(spark.createDataFrame([([1.0], 5.0)], "features array<double>, label double"))
    with pytest.raises(ValueError, match="labels must be"):
        L1Hinge(numClasses=2).fit(one)
    with pytest.raises(ValueError, match="labels must be"):
        StochasticL1Hinge(numClasses=2).fit(one)
