import math
import random

import pytest

from almanac.models.histogram_forest import DRAWS, HASH_SPACE, LABEL_UNIT, fit_histogram_forest, looked_at

KEY = ("id",)


def rows(n=400):
    rng = random.Random(2)
    out = []
    for i in range(n):
        a, b = rng.random(), rng.choice([0.0, 1.0, 2.0])
        out.append((i, a, b, rng.random(), 10.0 * (a > 0.5) + b + rng.gauss(0, 0.1)))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), "id long, a double, b double, c double, y double").cache()


def test_trees_do_not_depend_on_partitions(table):
    one = fit_histogram_forest(table.coalesce(1), ["a", "b", "c"], "y", KEY)
    many = fit_histogram_forest(table.repartition(7), ["a", "b", "c"], "y", KEY)
    assert one.rows() == many.rows() and len(one.rows()) > 30


def test_a_step_is_found_and_told_apart(spark, table):
    forest = fit_histogram_forest(table, ["a", "b", "c"], "y", KEY, trees=8)
    scored = forest.predict(table).collect()
    mean = sum(r.y for r in scored) / len(scored)
    error = sum((r.y - r.prediction) ** 2 for r in scored)
    assert error < 0.2 * sum((r.y - mean) ** 2 for r in scored)
    trees = forest.table(spark).collect()
    assert {r.tree for r in trees} == set(range(8)) and all((r.feature is None) == (r.threshold is None) for r in trees)
    children = {(r.tree, r.node): r for r in trees}
    for r in trees:
        if r.feature is not None:
            left, right = children[r.tree, 2 * r.node], children[r.tree, 2 * r.node + 1]
            assert left.n + right.n == r.n
            assert math.isclose((left.n * left["mean"] + right.n * right["mean"]) / r.n, r["mean"], abs_tol=1e-9)


def brute_split(data, features, weights):
    """Feature and threshold with the least squared error, over all cuts between values."""
    best = None
    for f in features:
        for cut in sorted({r[1 + f] for r in data})[:-1]:
            error = 0.0
            for side in (True, False):
                part = [(weights[r[0]], r[4]) for r in data if (r[1 + f] <= cut) == side]
                n = sum(w for w, _ in part)
                if not n:
                    break
                mean = sum(w * y for w, y in part) / n
                error += sum(w * (y - mean) ** 2 for w, y in part)
            else:
                if best is None or error < best[0] - 1e-9:
                    best = error, f, cut
    return best[1:]


def test_the_root_split_is_the_best_one(spark):
    import hashlib

    data = [(i, float(i % 5), float(i % 3), float(i % 7), float((i * 37) % 11 + 6 * (i % 5 > 2))) for i in range(60)]
    table = spark.createDataFrame(data, "id long, a double, b double, c double, y double")
    forest = fit_histogram_forest(table, ["a", "b", "c"], "y", KEY, depth=1)
    for t, tree in enumerate(forest.trees):
        draws = {r[0]: int(hashlib.md5(f"15:{t}:{r[0]}".encode()).hexdigest()[:8], 16) for r in data}
        weights = {i: sum(d >= bound for bound in DRAWS) for i, d in draws.items()}
        assert tree[1].n == sum(weights.values())
        feature, cut = brute_split(data, looked_at(15, t, 1, 3), weights)
        assert (tree[1].feature, forest.thresholds[feature][tree[1].place]) == (feature, cut)


def test_odd_rows(spark, table):
    schema = "id long, a double, b double, c double, y double"
    with pytest.raises(ValueError, match="no training rows"):
        fit_histogram_forest(table.limit(0), ["a", "b", "c"], "y", KEY)
    same = spark.createDataFrame([(i, 1.0, 1.0, None, 3.0) for i in range(20)], schema)
    forest = fit_histogram_forest(same, ["a", "b", "c"], "y", KEY)
    assert {r[1] for r in forest.rows()} == {1}
    assert {r.prediction for r in forest.predict(same).collect()} == {3.0}
    odd = table.unionByName(spark.createDataFrame([(1000, None, 1.0, 1.0, None), (None, 1.0, 1.0, 1.0, 1e6), (1001, 0.1, 1.0, 1.0, float("nan"))], schema))
    assert fit_histogram_forest(odd, ["a", "b", "c"], "y", KEY).rows() == fit_histogram_forest(table, ["a", "b", "c"], "y", KEY).rows()
    scored = fit_histogram_forest(table, ["a", "b", "c"], "y", KEY).predict(odd).where("a IS NULL").first()
    assert math.isfinite(scored.prediction)


def test_draws_follow_a_poisson_distribution():
    shares = [1 - b / HASH_SPACE for b in DRAWS]
    assert math.isclose(sum(shares), 1.0, abs_tol=1e-5) and math.isclose(1 - shares[0], math.exp(-1), abs_tol=1e-9)
    assert LABEL_UNIT == 2**20
