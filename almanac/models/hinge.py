"""Linear classifier with hinge loss and an L1 penalty, one weight row per class.

Spark's own hinge classifier has an L2 penalty only, which never makes a weight
exactly zero.  Training is proximal gradient descent: each pass is one Spark job
in which every task reduces its rows to one gradient, and tasks' gradients are
summed in two rounds of aggregation.  All classes share each pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasRegParam, HasTol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.models.caching import cached

# Steps running without progress before training stops.
PATIENCE = 5

# Tasks whose gradients are added up in the first round of aggregation.
FAN_IN = 64

# Share of the expected gain that a step must reach, and bounds of the curvature estimate.
ENOUGH = 1e-4
FLATTEST, STEEPEST = 1e-3, 1e6


class L1Hinge(
    Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRegParam, HasTol, HasMaxIter,
    DefaultParamsWritable, DefaultParamsReadable,
):
    """One-versus-rest smoothed hinge loss plus ``regParam`` times the weights' L1 norm.

    Stops after ``maxIter`` passes, or when ``PATIENCE`` steps running have each improved
    the mean objective of a class by less than ``tol``.
    """

    numClasses = Param(Params._dummy(), "numClasses", "labels are 0..numClasses-1", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, numClasses=2, featuresCol="features", labelCol="label", predictionCol="prediction",
                 regParam=0.02, tol=1e-6, maxIter=1000):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(numClasses=2, regParam=0.02, tol=1e-6, maxIter=1000)

    def _fit(self, dataset: DataFrame) -> L1HingeModel:
        with cached(dataset) as kept:
            train = kept.select(
                vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y")
            )
            weights, passes = _descend(
                train, self.getOrDefault(self.numClasses), self.getRegParam(), self.getTol(), self.getMaxIter()
            )
        model = L1HingeModel(
            numClasses=len(weights), weights=[float(w) for w in weights.ravel()],
            featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
        )
        model.passes = passes
        return model


class L1HingeModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsWritable, DefaultParamsReadable):
    """Predicts the class with the largest margin.  ``passes``: steps the training tried, None once loaded."""

    passes: int | None = None

    numClasses = Param(Params._dummy(), "numClasses", "number of weight rows", TypeConverters.toInt)
    weights = Param(
        Params._dummy(), "weights", "weight rows one after the other, the intercept last in each",
        TypeConverters.toListFloat,
    )

    @keyword_only
    def __init__(self, *, numClasses=None, weights=None, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def matrix(self) -> np.ndarray:
        return np.array(self.getOrDefault(self.weights)).reshape(self.getOrDefault(self.numClasses), -1)

    @property
    def coefficient_rows(self) -> np.ndarray:
        return self.matrix[:, :-1]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        matrix = self.matrix

        @F.pandas_udf("double")
        def largest_margin(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="float64")
            margins = np.stack(x.to_numpy()) @ matrix[:, :-1].T + matrix[:, -1]
            return pd.Series(margins.argmax(axis=1).astype("float64"))

        return dataset.withColumn(self.getPredictionCol(), largest_margin(vector_to_array(self.getFeaturesCol())))


def _descend(train: DataFrame, classes: int, penalty: float, tol: float, max_iter: int) -> tuple[np.ndarray, int]:
    """Proximal gradient steps that never raise the objective.

    The step length follows the change of the gradient over the last step; a step that
    does not lower the objective enough is retried at half the length.  The driver holds
    a few weight matrices and no data.
    """
    n, width, least, most = train.agg(F.count("*"), F.max(F.size("x")), F.min("y"), F.max("y")).first()
    if not n:
        raise ValueError("no training rows")
    if least is None or least < 0 or most >= classes:
        raise ValueError(f"labels must be 0 to {classes - 1}, found {least} to {most}")

    def evaluate(at: np.ndarray) -> tuple[np.ndarray, float]:
        gradient, loss = _hinge_pass(train, n, at)
        return gradient, loss + penalty * float(np.abs(at[:, :-1]).sum())

    weights = np.zeros((classes, width + 1))
    gradient, objective = evaluate(weights)
    curvature, stale, passes = 1.0, 0, 0
    for passes in range(1, max_iter + 1):
        moved = weights - gradient / curvature
        tried = np.sign(moved) * np.maximum(np.abs(moved) - penalty / curvature, 0.0)
        tried[:, -1] = moved[:, -1]
        step = tried - weights
        length = float((step * step).sum())
        if length == 0.0:
            break
        tried_gradient, tried_objective = evaluate(tried)
        gain = objective - tried_objective
        if gain < ENOUGH * curvature * length:
            curvature *= 2.0
            continue
        bend = float((step * (tried_gradient - gradient)).sum()) / length
        curvature = min(max(bend, FLATTEST), STEEPEST)
        weights, gradient, objective = tried, tried_gradient, tried_objective
        stale = 0 if gain / classes >= tol else stale + 1
        if stale >= PATIENCE:
            break
    return weights, passes


def _hinge_pass(train: DataFrame, n: int, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Mean gradient and mean loss of all classes at ``weights``."""

    def partial(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        sign = np.where(y[:, None] == np.arange(len(weights)), 1.0, -1.0)
        margin = sign * (x @ weights.T)
        short = np.clip(1.0 - margin, 0.0, None)
        # Quadratic below one unit short of the margin, linear beyond: the hinge with its corner rounded.
        loss = np.where(short < 1.0, 0.5 * short * short, short - 0.5)
        slope = -sign * np.minimum(short, 1.0)
        return np.append((slope.T @ x).ravel(), loss.sum())

    total = _summed(train, partial) / n
    return total[:-1].reshape(weights.shape), float(total[-1])


def _summed(train: DataFrame, partial: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``partial(x, y)`` over all rows; ``x`` gets a trailing 1 for the intercept."""

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            x = np.hstack([x, np.ones((len(x), 1))])
            part = partial(x, batch.column(1).to_numpy())
            total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array([total], pa.list_(pa.float64()))], names=["g"])

    sums = train.mapInArrow(reduce_rows, "g array<double>").select(
        array_to_vector("g").alias("g"), F.floor(F.spark_partition_id() / FAN_IN).alias("group")
    )
    sums = sums.groupBy("group").agg(Summarizer.sum(F.col("g")).alias("g"))
    return sums.agg(Summarizer.sum(F.col("g")).alias("g")).first()["g"].toArray()
