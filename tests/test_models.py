import datetime as dt
import math
import random
import warnings

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from almanac.models import classifiers
from almanac.models.forest import LAG_FEATURES, fit_forest
from almanac.operators import metrics, scaling
from almanac.plans import digits, weather
from almanac.sinks.models import load_model, save_model


@pytest.fixture(scope="module")
def separable(spark):
    """Three well separated blobs in four dimensions; the last two are noise and a constant."""
    rng = random.Random(5)
    centres = [(-3.0, 0.0), (3.0, 0.0), (0.0, 4.0)]
    rows = [
        (i, [centres[i % 3][0] + rng.gauss(0, 0.5), centres[i % 3][1] + rng.gauss(0, 0.5), rng.gauss(0, 1), 7.0], i % 3)
        for i in range(300)
    ]
    return spark.createDataFrame(rows, "id long, features array<double>, label int").coalesce(2).cache()


def test_scaler_uses_the_population_and_leaves_constants_alone(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([2.0, 5.0],), ([4.0, 5.0],)], "x array<double>")
    fitted = scaling.fit_scaler(df, "x").first()
    mean = 7 / 3
    deviation = math.sqrt(sum((v - mean) ** 2 for v in (1, 2, 4)) / 3)
    assert fitted.n == 3
    assert fitted["mean"] == pytest.approx([mean, 5.0])
    assert fitted.sd == pytest.approx([deviation, 0.0])
    scaled = [r.scaled for r in scaling.standardize(df, "x", scaling.fit_scaler(df, "x")).collect()]
    assert sorted(s[0] for s in scaled) == pytest.approx(sorted((v - mean) / deviation for v in (1, 2, 4)))
    assert all(s[1] == 0.0 for s in scaled)


def test_test_rows_are_scaled_with_train_statistics(spark):
    train = spark.createDataFrame([([0.0],), ([2.0],)], "x array<double>")
    test = spark.createDataFrame([([5.0],)], "x array<double>")
    assert scaling.standardize(test, "x", scaling.fit_scaler(train, "x")).first().scaled == [4.0]


def test_scaled_train_set_has_mean_zero_and_deviation_one(separable):
    scaled = scaling.standardize(separable, "features", scaling.fit_scaler(separable, "features"))
    stats = scaling.feature_stats(scaled, "scaled").orderBy("pos").collect()
    assert [r["mean"] for r in stats] == pytest.approx([0.0] * 4, abs=1e-9)
    assert [r.sd for r in stats] == pytest.approx([1.0, 1.0, 1.0, 0.0])


def test_model_scaling_equals_the_operator(separable):
    model = classifiers.fit_scaling(classifiers.with_vector(separable))
    ml = model.transform(classifiers.with_vector(separable)).select("id", vector_to_array("scaled").alias("a"))
    ours = scaling.standardize(separable, "features", scaling.fit_scaler(separable, "features")).select("id", "scaled")
    for r in ml.join(ours, "id").collect():
        assert r.a == pytest.approx(r.scaled)


@pytest.mark.parametrize(
    "make",
    [
        classifiers.l1_logistic,
        lambda: classifiers.l1_hinge(3),
        classifiers.linear_svc,
        lambda: classifiers.perceptron([4, 6, 3]),
    ],
    ids=["l1_logistic", "l1_hinge", "linear_svc", "perceptron"],
)
def test_classifiers_learn_separable_classes(separable, make):
    scored = digits.classify(separable, make())
    got = metrics.accuracy(scored, "prediction", "label").first()
    assert got.n == 75
    assert got.acc >= 0.95


def test_l1_models_drop_noise_and_constants_and_survive_saving(separable, folder):
    models = classifiers.fit_models(
        separable, {"l1_logistic": classifiers.l1_logistic(), "l1_hinge": classifiers.l1_hinge(3)}
    )
    weights = classifiers.coefficients(separable.sparkSession, models)
    assert weights.count() == 2 * 3 * 4
    assert weights.where("feature = 3 and value != 0").count() == 0
    for name, model in models.items():
        save_model(model, f"{folder}/{name}")
        save_model(model, f"{folder}/{name}")
        loaded = load_model(f"{folder}/{name}")
        assert sorted(classifiers.predict(loaded, separable).collect()) == sorted(
            classifiers.predict(model, separable).collect()
        )


def test_hinge_penalty_is_what_makes_weights_zero(separable):
    def zeros(penalty):
        model = classifiers.fit_models(separable, {"m": classifiers.l1_hinge(3, penalty, tol=1e-3)})["m"]
        return (model.stages[-1].coefficient_rows == 0).sum()

    assert zeros(0.0) < zeros(0.05) < zeros(10.0) == 12


def test_hinge_reaches_the_optimum_of_a_small_problem(spark):
    # Rows -1 and +1 in one dimension: by symmetry the classes' weights are -w and w.
    rows = classifiers.with_vector(
        spark.createDataFrame([([-1.0], 0.0), ([1.0], 1.0)], "features array<double>, label double")
    )
    from almanac.models.hinge import L1Hinge

    penalty = 0.2
    model = L1Hinge(numClasses=2, regParam=penalty, tol=1e-9, maxIter=200).fit(rows)
    # Mean loss 0.5 * (1 - w)^2 plus penalty * w is least where 1 - w = penalty.
    assert model.coefficient_rows.ravel().tolist() == pytest.approx([-(1 - penalty), 1 - penalty], abs=1e-3)
    assert model.matrix[:, -1].tolist() == pytest.approx([0.0, 0.0], abs=1e-3)


def test_compare_saved_models(separable, folder):
    got = digits.compare_saved(
        separable, {"a": classifiers.l1_logistic(), "b": classifiers.l1_hinge(3)}, folder
    ).collect()
    assert sorted(r.model for r in got) == ["a", "b"]
    assert all(r.acc >= 0.95 and r.n == 75 and r.zero_pct >= 25.0 for r in got)


def observed(spark, stations=20, days=60):
    start = dt.date(2024, 1, 1)
    rows = [
        (f"S{s}", start + dt.timedelta(days=d), float(s % 7), float(s), float(100 * s), float(s + d))
        for s in range(stations)
        for d in range(days)
    ]
    return spark.createDataFrame(
        rows, "station string, date date, latitude float, longitude float, elevation float, tmax float"
    )


def test_forest_beats_the_mean_on_held_out_days(spark):
    df = observed(spark)
    scored = weather.forecast(df)
    got = metrics.regression_metrics(scored, "tmax", "prediction").first()
    assert got.r2 > 0.6
    assert abs(scored.count() / df.count() - 0.25) < 0.06


def test_forest_model_carries_its_sql_stage_through_saving(spark, folder):
    df = observed(spark)
    model = fit_forest(df)
    forest = model.stages[-1]
    assert forest.getNumTrees == 3 and max(t.depth for t in forest.trees) <= 4
    save_model(model, folder + "/m")
    assert "prediction" in load_model(folder + "/m").transform(df).columns


def test_forest_on_yesterdays_value(spark):
    lagged = observed(spark).withColumn("yesterday_tmax", F.col("tmax") - 1)
    got = metrics.regression_metrics(weather.forecast(lagged, LAG_FEATURES), "tmax", "prediction").first()
    assert got.r2 > 0.6


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, p double")
    got = metrics.regression_metrics(df, "y", "p").first()
    assert got.rmse == pytest.approx(math.sqrt(5 / 3), abs=1e-6)
    assert got.mae == pytest.approx(1.0)
    assert got.r2 == pytest.approx(1 - 5 / 8)


def test_rows_without_a_prediction_do_not_count(spark):
    rows = [(1.0, 1.0), (2.0, 1.5), (90.0, None)]
    got = metrics.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    assert got.r2 == pytest.approx(1 - 0.125 / 0.25)


def test_vectors_of_another_width_are_an_error(spark):
    scaler = scaling.fit_scaler(spark.createDataFrame([([1.0, 2.0],), ([3.0, 5.0],), (None,)], "x array<double>"), "x")
    assert scaler.first().n == 2
    for wrong in ([1.0], [1.0, 2.0, 3.0]):
        df = spark.createDataFrame([(wrong,)], "x array<double>")
        with pytest.raises(Exception, match="expected 2 elements"):
            scaling.standardize(df, "x", scaler).collect()
    nothing = spark.createDataFrame([(None,)], "x array<double>")
    assert scaling.standardize(nothing, "x", scaler).first().scaled is None


def test_labels_out_of_range_are_an_error(separable):
    with pytest.raises(ValueError, match="labels must be 0 to 1"):
        classifiers.fit_models(separable, {"m": classifiers.l1_hinge(2)})


def test_training_goes_on_until_it_converges(spark):
    """Vectors whose classes are hard to tell apart: the first step must not be taken for the end."""
    from almanac.plans.inputs import vectors

    train, test = digits.train_and_test(vectors(spark, "/root/testdata/sf0.01"))
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        models = classifiers.fit_models(
            train, {"l1_logistic": classifiers.l1_logistic(), "l1_hinge": classifiers.l1_hinge(10), "linear_svc": classifiers.linear_svc()}
        )
    for model in models.values():
        assert all(1 <= steps < classifiers.MOST_STEPS for steps in classifiers.steps_taken(model.stages[-1]))
    logistic = models["l1_logistic"].stages[-1]
    history = logistic.summary.objectiveHistory
    assert history[-1] < history[0] - 0.01
    assert (logistic.coefficientMatrix.toArray() != 0).any()
    assert classifiers.predict(models["l1_logistic"], test).select("prediction").distinct().count() > 1


def test_the_scaled_training_set_has_no_lineage(separable):
    """Every step of a fit is a job, which must not carry the plan of the split to its tasks; partitions stay as they are."""
    seen = []

    class Probe:
        def getMaxIter(self):
            return classifiers.MOST_STEPS

        def fit(self, rows):
            seen.append((rows.count(), rows.rdd.getNumPartitions(), rows._jdf.queryExecution().optimizedPlan().toString()))
            return classifiers.l1_logistic().fit(rows)

    classifiers.fit_models(separable.repartition(12, "id").withColumn("id", F.col("id") + 0), {"m": Probe()})
    ((rows, parts, plan),) = seen
    assert (rows, parts) == (300, 12)
    assert "Exchange" not in plan


def test_a_fit_that_meets_its_cap_is_reported(separable):
    with pytest.warns(RuntimeWarning, match="stopped after 1 steps"):
        classifiers.fit_models(separable, {"m": classifiers.l1_logistic(max_iter=1)})


def test_the_scaler_is_one_job(separable):
    rows = classifiers.with_vector(separable)
    rows.count()
    context = separable.sparkSession.sparkContext
    context.setJobGroup("scaler", "scaler")
    try:
        classifiers.fit_scaling(rows)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("scaler")) <= 2  # adaptive execution runs a shuffle as a job


def test_r2_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert metrics.regression_metrics(df, "y", "p").first().r2 is None
