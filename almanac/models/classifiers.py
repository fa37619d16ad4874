"""Classifiers on standardised vectors.  The scaler is a stage of the saved model."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    OneVsRestModel,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.models.caching import cached
from almanac.models.hinge import L1Hinge, L1HingeModel
from almanac.models.perceptron import PackedPerceptron
from almanac.models.standardiser import fit_standardiser
from almanac.models.stochastic import PLACE, SagaL1Logistic, StochasticL1Hinge, content_hash
from almanac.operators import metrics
from almanac.staging import checkpointed

# Fixed value: with C = 50 / n the penalty 1 / (C * n) is 0.02 for every n.
L1_PENALTY = 0.02

# Relative change of the objective at which training ends, and a cap on steps that it should never meet.
# The hinge loss of Spark's own classifier creeps near its optimum, so it ends earlier.
TOLERANCE, SVC_TOLERANCE = 1e-6, 0.1
MOST_STEPS = 1000


def with_vector(df: DataFrame, column: str = "features") -> DataFrame:
    return df.withColumn(column, array_to_vector(F.col(column)))


def fit_scaling(train: DataFrame, column: str = "features", out: str = "scaled") -> PipelineModel:
    """Scale by mean and population deviation of ``train``; constant features become 0."""
    return PipelineModel([fit_standardiser(train, column, out)])


def l1_logistic(penalty: float = L1_PENALTY, tol: float = TOLERANCE, max_iter: int = MOST_STEPS) -> Estimator:
    """Multinomial logistic regression with a pure L1 penalty on scaled features."""
    return LogisticRegression(
        featuresCol="scaled", labelCol="label", family="multinomial",
        regParam=penalty, elasticNetParam=1.0, standardization=False, tol=tol, maxIter=max_iter,
    )


def l1_hinge(classes: int, penalty: float = L1_PENALTY, tol: float = TOLERANCE, max_iter: int = MOST_STEPS) -> Estimator:
    """Hinge loss with a pure L1 penalty on scaled features, one weight row per class."""
    return L1Hinge(
        numClasses=classes, featuresCol="scaled", labelCol="label", regParam=penalty, tol=tol, maxIter=max_iter
    )


def stochastic_l1_hinge(classes: int, penalty: float = L1_PENALTY, passes: int = 5, seed: int = 0) -> Estimator:
    """The objective of :func:`l1_hinge`, by stochastic steps in a fixed number of passes."""
    return StochasticL1Hinge(
        numClasses=classes, featuresCol="scaled", labelCol="label", regParam=penalty, maxIter=passes, seed=seed
    )


def saga_l1_logistic(classes: int, penalty: float = L1_PENALTY, seed: int = 0) -> Estimator:
    """The objective of :func:`l1_logistic`, by variance-reduced stochastic steps."""
    return SagaL1Logistic(numClasses=classes, featuresCol="scaled", labelCol="label", regParam=penalty, seed=seed)


def linear_svc(
    penalty: float = L1_PENALTY, tol: float = SVC_TOLERANCE, max_iter: int = MOST_STEPS, parallelism: int = 4
) -> Estimator:
    """One hinge-loss classifier per class with an L2 penalty, Spark's own."""
    single = LinearSVC(
        featuresCol="scaled", regParam=penalty, standardization=False, tol=tol, maxIter=max_iter
    )
    return OneVsRest(classifier=single, featuresCol="scaled", labelCol="label", parallelism=parallelism)


def perceptron(layers: Sequence[int], seed: int = 0, max_iter: int = MOST_STEPS) -> Estimator:
    return MultilayerPerceptronClassifier(
        featuresCol="scaled", labelCol="label", layers=list(layers), seed=seed, tol=TOLERANCE, maxIter=max_iter
    )


def packed_perceptron(layers: Sequence[int], seed: int = 0, max_iter: int = MOST_STEPS) -> Estimator:
    """The objective and the steps of :func:`perceptron`, taken on packed rows; only sums round otherwise."""
    return PackedPerceptron(
        featuresCol="scaled", labelCol="label", layers=list(layers), seed=seed, tol=TOLERANCE, maxIter=max_iter
    )


def fit_models(train: DataFrame, estimators: dict[str, Estimator]) -> dict[str, PipelineModel]:
    """Fit every estimator on one scaled training set in memory; each model carries the scaler.

    The training rows are kept while they are scaled, the scaled ones while models pass over them.  These
    are written once without their lineage, which every job of a fit would carry to its tasks.  They keep
    their partitions: other sums would round otherwise, and a perceptron end elsewhere.  The fits run side by side, since
    each waits for many short jobs.  A fit that took no step, or was stopped by its cap on steps, is reported as a warning.
    """
    labelled = train.select("features", F.col("label").cast("double").alias("label"))
    # The stochastic solvers go by the order of a hash of the rows as they were given.
    rows = with_vector(labelled.withColumn(PLACE, content_hash("features", "label")))
    with cached(rows) as kept:
        scaling = fit_scaling(kept)
        whole = checkpointed(scaling.transform(kept).select("scaled", "label", PLACE))
    with cached(whole) as scaled, ThreadPool(max(1, len(estimators))) as pool:
        fit = inheritable_thread_target(train.sparkSession)(lambda name: estimators[name].fit(scaled))
        fitted = dict(zip(estimators, pool.map(fit, estimators), strict=True))
    for name, model in fitted.items():
        for steps in steps_taken(model):
            if not isinstance(estimators[name], StochasticL1Hinge) and not 0 < steps < _most_steps(estimators[name]):
                warnings.warn(f"{name} stopped after {steps} steps", RuntimeWarning, stacklevel=2)
    return {name: PipelineModel([*scaling.stages, model]) for name, model in fitted.items()}


def steps_taken(model: Model) -> list[int]:
    """Steps of each fit inside a model just trained."""
    if isinstance(model, OneVsRestModel):
        return [single.summary().totalIterations for single in model.models]
    if isinstance(model, L1HingeModel) or hasattr(model, "passes"):
        return [model.passes]
    summary = model.summary() if callable(model.summary) else model.summary
    return [summary.totalIterations]


def _most_steps(estimator: Estimator) -> int:
    return (estimator.getClassifier() if isinstance(estimator, OneVsRest) else estimator).getMaxIter()


def predict(model: PipelineModel, test: DataFrame) -> DataFrame:
    """(id, label, prediction) for every test row."""
    return model.transform(with_vector(test)).select("id", "label", "prediction")


def predict_all(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Tall table (id, label, model, pred); all models score a row in one pass over the test set."""
    scored = with_vector(test.select("id", "label", "features"))
    kept = scored.columns
    for name, model in models.items():
        kept = [*kept, f"__{name}"]
        scored = model.transform(scored).withColumnRenamed("prediction", f"__{name}").select(*kept)
    tall = metrics.tall_predictions(scored, {name: F.col(f"__{name}") for name in models})
    return tall.select("id", "label", "model", "pred")


def coefficients(spark: SparkSession, models: dict[str, PipelineModel]) -> DataFrame:
    """(model, class, feature, value): as many rows as the models have weights."""
    rows = [
        (name, k, j, float(value))
        for name, model in models.items()
        for k, weights in enumerate(_weight_rows(model))
        for j, value in enumerate(weights)
    ]
    return spark.createDataFrame(rows, "model string, class int, feature int, value double")


def intercepts(spark: SparkSession, models: dict[str, PipelineModel]) -> DataFrame:
    """(model, class, intercept)."""
    rows = [
        (name, k, float(value))
        for name, model in models.items()
        for k, value in enumerate(_intercepts(model.stages[-1]))
    ]
    return spark.createDataFrame(rows, "model string, class int, intercept double")


def compare_models(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """(model, acc, n, zero_pct) on held-out rows."""
    spark = test.sparkSession
    scores = metrics.compare_predictors(predict_all(models, test), "label")
    sparsity = coefficients(spark, models).groupBy("model").agg(
        metrics.share_of_zeros(F.col("value")).alias("zero_pct")
    )
    return scores.join(sparsity, "model", "left")


def optimality(model: PipelineModel, train: DataFrame, penalty: float = L1_PENALTY) -> DataFrame:
    """(class, feature, value, gradient, gap) of an L1 logistic model, from its coefficient table and the training rows.

    ``gap`` says by how much a coefficient violates the conditions of the optimum: a zero one needs a gradient of no more than
    the penalty, any other the penalty against its sign; the intercept (feature -1) a gradient of 0.
    """
    spark = train.sparkSession
    weights = coefficients(spark, {"m": model}).unionByName(
        intercepts(spark, {"m": model}).select("model", "class", F.lit(-1).alias("feature"), F.col("intercept").alias("value"))
    ).drop("model")
    rows = model.stages[0].transform(with_vector(train)).select(
        F.xxhash64("id").alias("row"), "label", vector_to_array("scaled").alias("x")
    )
    with_one = rows.select("row", "label", F.posexplode(F.concat("x", F.array(F.lit(1.0)))).alias("at", "x"))
    long_form = with_one.withColumn("feature", F.when(F.col("at") == F.max("at").over(Window.partitionBy("row")), -1).otherwise(F.col("at")))
    margins = long_form.join(weights, "feature").groupBy("row", "label", "class").agg(F.sum(F.col("x") * F.col("value")).alias("margin"))
    of_row = Window.partitionBy("row")
    shares = margins.withColumn("share", F.exp(F.col("margin") - F.max("margin").over(of_row))).withColumn(
        "residual", F.col("share") / F.sum("share").over(of_row) - (F.col("label") == F.col("class")).cast("double")
    )
    n = train.count()
    gradients = shares.join(long_form.select("row", "feature", "x"), "row").groupBy("class", "feature").agg(
        (F.sum(F.col("residual") * F.col("x")) / n).alias("gradient")
    )
    value, gradient = F.col("value"), F.col("gradient")
    gap = F.when(F.col("feature") == -1, F.abs(gradient)).when(value == 0, F.greatest(F.abs(gradient) - penalty, F.lit(0.0))).otherwise(
        F.abs(gradient + penalty * F.signum(value))
    )
    return weights.join(gradients, ["class", "feature"]).withColumn("gap", gap)


def _intercepts(fitted: Model) -> Sequence[float]:
    if isinstance(fitted, L1HingeModel):
        return fitted.matrix[:, -1]
    if isinstance(fitted, OneVsRestModel):
        return [single.intercept for single in fitted.models]
    return fitted.interceptVector.toArray()


def _weight_rows(model: PipelineModel) -> Iterator[Sequence[float]]:
    fitted = model.stages[-1]
    if isinstance(fitted, OneVsRestModel):
        return (single.coefficients.toArray() for single in fitted.models)
    if isinstance(fitted, L1HingeModel):
        return iter(fitted.coefficient_rows)
    if hasattr(fitted, "coefficientMatrix"):
        return iter(fitted.coefficientMatrix.toArray())
    return iter(())
