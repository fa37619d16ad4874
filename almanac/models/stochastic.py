"""Stochastic solvers for linear classifiers with an L1 penalty.

Rows are dealt into shards by a hash of their content and stand in a shard in the order of that hash, so which row
follows which depends on the rows and the seed, not on partitions or retries.  A pass is one Spark job: the task that has a
shard walks through it in batches of ``BATCH`` rows from the weights of the pass before, and the shards' weights are
averaged by their numbers of rows, in the order of the shards.  A task holds a batch and a few weight
matrices; the driver receives one weight matrix for each shard, ``MOST_SHARDS`` at most.

:class:`StochasticL1Hinge` takes plain gradient steps on the hinge loss and clips each weight by the penalty that it has
not had yet (cumulative clipping), which leaves weights at exactly zero.  :class:`SagaL1Logistic` keeps for each row the residual of
its last visit beside the row.  The row's gradient is residual times features, so a step corrects the mean of all stored gradients by
what has changed in the batch, and its error vanishes as the weights settle; its steps end by proximal shrinkage.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasRegParam, HasSeed, HasTol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.models.caching import cached
from almanac.models.hinge import L1HingeModel
from almanac.staging import checkpointed

# Rows of a step; rows for which a further shard is opened, and most shards.
BATCH = 32
SHARD_ROWS, MOST_SHARDS = 4096, 256

# First step length of the hinge solver, as a multiple of 1 / features; it falls as 1 / (1 + pass).
FIRST_STEP = 16.0

# Rows from whose covariance the logistic solver takes the steepest direction.
STEEPEST_SAMPLE = 2048

# Name of an optional column that stands for a row's content before scaling.
PLACE = "place"

ROW = "shard int, place bigint, x array<double>, y int, residual array<double>, weights array<double>, gradient array<double>, n bigint"


def content_hash(*columns: Column | str) -> Column:
    """A place in the order of rows, from values that no rounding has touched."""
    return F.xxhash64(F.lit("row"), *columns)


@dataclass
class _Walk:
    """What a task knows while it walks through one shard; solvers subclass it."""

    weights: np.ndarray
    rows: int = 0

    def step(self, x: np.ndarray, y: np.ndarray, residual: np.ndarray | None) -> np.ndarray | None:
        raise NotImplementedError


class _HingeWalk(_Walk):
    def __init__(self, weights: np.ndarray, rate: float, penalty: float):
        super().__init__(weights.copy())
        self.rate, self.penalty, self.due = rate, penalty, 0.0
        self.had = np.zeros((len(weights), weights.shape[1] - 1))

    def step(self, x, y, residual):
        sign = np.where(y[:, None] == np.arange(len(self.weights)), 1.0, -1.0)
        short = np.clip(1.0 - sign * (x @ self.weights.T), 0.0, 1.0)
        self.weights -= self.rate * ((-sign * short).T @ x) / len(x)
        self.due += self.rate * self.penalty
        moved = self.weights[:, :-1].copy()
        clipped = np.where(
            moved > 0, np.maximum(0.0, moved - (self.due + self.had)), np.where(moved < 0, np.minimum(0.0, moved + (self.due - self.had)), 0.0)
        )
        self.had += clipped - moved
        self.weights[:, :-1] = clipped
        return None


class _SagaWalk(_Walk):
    def __init__(self, weights: np.ndarray, gradient: np.ndarray, rate: float, penalty: float, n: int):
        super().__init__(weights.copy())
        self.gradient, self.change = gradient.copy(), np.zeros_like(gradient)
        self.rate, self.penalty, self.n = rate, penalty, n

    def step(self, x, y, residual):
        now = softmax_residual(self.weights, x, y)
        changed = (now - residual).T @ x
        self.weights = shrunk(self.weights - self.rate * (changed / len(x) + self.gradient), self.rate * self.penalty)
        self.gradient += changed / self.n
        self.change += changed / self.n
        return now


def softmax_residual(weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Predicted shares of the classes less the actual ones; the last column of ``x`` is 1."""
    margins = x @ weights.T
    shares = np.exp(margins - margins.max(axis=1, keepdims=True))
    shares /= shares.sum(axis=1, keepdims=True)
    shares[np.arange(len(y)), y] -= 1.0
    return shares


def shrunk(weights: np.ndarray, by: float) -> np.ndarray:
    out = np.sign(weights) * np.maximum(np.abs(weights) - by, 0.0)
    out[:, -1] = weights[:, -1]
    return out


def optimality_gap(weights: np.ndarray, gradient: np.ndarray, penalty: float) -> float:
    """Largest violation of the conditions of the penalised optimum; 0 at the optimum."""
    w, g = weights[:, :-1], gradient[:, :-1]
    gap = np.where(w == 0, np.maximum(np.abs(g) - penalty, 0.0), np.abs(g + penalty * np.sign(w)))
    return float(max(gap.max(initial=0.0), np.abs(gradient[:, -1]).max(initial=0.0)))


def dealt(train: DataFrame, shards: int, seed: int, classes: int) -> DataFrame:
    """(shard, place, x, y, residual) by shard and, in each, by place.  The residual is that of weights 0."""
    place = F.xxhash64(F.lit(seed), "place")
    hot = F.array(*[F.lit(1.0 / classes) - (F.col("y") == k).cast("double") for k in range(classes)])
    return (
        train.select(F.pmod(place, F.lit(shards)).cast("int").alias("shard"), place.alias("place"), "x", "y")
        .repartition("shard").sortWithinPartitions("shard", "place", "x", "y")
        .select("shard", "place", "x", "y", hot.alias("residual"))
    )


def _walked(start: Callable[[], _Walk], keep_rows: bool):
    """Walk through the shards of a partition; returns one row for each shard, and the rows with new residuals if kept."""

    def summary(shard: int, walk: _Walk) -> pa.RecordBatch:
        gradient = walk.change.ravel() if isinstance(walk, _SagaWalk) else None
        return _batch([shard], [0], [None], [0], [None], [walk.weights.ravel()], [gradient], [walk.rows])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, walk, held = None, None, []

        def stepped(rows: list[tuple]) -> pa.RecordBatch | None:
            x = np.array([r[1] for r in rows])
            y = np.array([r[2] for r in rows])
            residual = np.array([r[3] for r in rows])
            new = walk.step(np.hstack([x, np.ones((len(x), 1))]), y, residual)
            walk.rows += len(rows)
            if keep_rows:
                none = [None] * len(rows)
                return _batch([shard] * len(rows), [r[0] for r in rows], list(x), y, list(new), none, none, none)
            return None

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            shards = columns[0].to_numpy()
            for i in range(batch.num_rows):
                if shards[i] != shard:
                    if held and (done := stepped(held)):
                        yield done
                    if walk is not None:
                        yield summary(shard, walk)
                    shard, walk, held = int(shards[i]), start(), []
                held.append((columns[1][i].as_py(), columns[2][i].values.to_numpy(), columns[3][i].as_py(), columns[4][i].values.to_numpy()))
                if len(held) == BATCH:
                    if done := stepped(held):
                        yield done
                    held = []
        if held and (done := stepped(held)):
            yield done
        if walk is not None:
            yield summary(shard, walk)

    return of_batches


def _batch(shard, place, x, y, residual, weights, gradient, n) -> pa.RecordBatch:
    floats = pa.list_(pa.float64())
    return pa.RecordBatch.from_pydict(
        {
            "shard": pa.array(shard, pa.int32()), "place": pa.array(place, pa.int64()), "x": pa.array(x, floats),
            "y": pa.array(y, pa.int32()), "residual": pa.array(residual, floats), "weights": pa.array(weights, floats),
            "gradient": pa.array(gradient, floats), "n": pa.array(n, pa.int64()),
        }
    )


def _averaged(summaries: list, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Weights averaged by rows, and the shards' changes of the gradient added up, both in the order of the shards."""
    weights, change, rows = np.zeros(shape), np.zeros(shape), sum(s["n"] for s in summaries)
    for s in sorted(summaries, key=lambda s: s["shard"]):
        weights += np.array(s["weights"]).reshape(shape) * (s["n"] / rows)
        if s["gradient"] is not None:
            change += np.array(s["gradient"]).reshape(shape)
    return weights, change


class _Stochastic(
    Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRegParam, HasMaxIter, HasSeed, HasTol,
    DefaultParamsWritable, DefaultParamsReadable,
):
    numClasses = Param(Params._dummy(), "numClasses", "labels are 0..numClasses-1", TypeConverters.toInt)

    def _rows(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(self.getFeaturesCol())
        y = F.col(self.getLabelCol()).cast("int")
        place = F.col(PLACE) if PLACE in dataset.columns else content_hash(x, y)
        return dataset.select(x.alias("x"), y.alias("y"), place.alias("place"))

    def _fit(self, dataset: DataFrame) -> L1HingeModel:
        rows, classes = self._rows(dataset), self.getOrDefault(self.numClasses)
        n, width, least, most = rows.agg(F.count("*"), F.max(F.size("x")), F.min("y"), F.max("y")).first()
        if not n:
            raise ValueError("no training rows")
        if least is None or least < 0 or most >= classes:
            raise ValueError(f"labels must be 0 to {classes - 1}, found {least} to {most}")
        shards = min(MOST_SHARDS, -(-n // SHARD_ROWS))
        weights, passes = self._solve(dealt(rows, shards, self.getSeed(), classes), n, (classes, width + 1))
        model = L1HingeModel(
            numClasses=classes, weights=[float(w) for w in weights.ravel()],
            featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
        )
        model.passes = passes
        return model

    def _solve(self, rows: DataFrame, n: int, shape: tuple[int, int]) -> tuple[np.ndarray, int]:
        raise NotImplementedError


class StochasticL1Hinge(_Stochastic):
    """One-versus-rest smoothed hinge loss plus ``regParam`` times the weights' L1 norm, in ``maxIter`` passes."""

    @keyword_only
    def __init__(self, *, numClasses=2, featuresCol="features", labelCol="label", predictionCol="prediction",
                 regParam=0.02, maxIter=5, seed=0):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(numClasses=2, regParam=0.02, maxIter=5, seed=0)

    def _solve(self, rows, n, shape):
        weights, penalty = np.zeros(shape), self.getRegParam()
        with cached(rows) as kept:
            for done in range(self.getMaxIter()):
                rate, at = FIRST_STEP / shape[1] / (1 + done), weights
                walk = _walked(lambda rate=rate, at=at: _HingeWalk(at, rate, penalty), keep_rows=False)
                weights, _ = _averaged(kept.mapInArrow(walk, ROW).collect(), shape)
        return weights, self.getMaxIter()


class SagaL1Logistic(_Stochastic):
    """Multinomial logistic loss plus ``regParam`` times the weights' L1 norm.

    Ends when no weight violates the conditions of the optimum by more than ``tol``, or after ``maxIter`` passes with a warning.
    """

    @keyword_only
    def __init__(self, *, numClasses=2, featuresCol="features", labelCol="label", predictionCol="prediction",
                 regParam=0.02, maxIter=200, tol=5e-4, seed=0):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(numClasses=2, regParam=0.02, maxIter=200, tol=5e-4, seed=0)

    def _solve(self, rows, n, shape):
        penalty, weights = self.getRegParam(), np.zeros(shape)
        kept = checkpointed(rows)
        gradient = _mean_gradient(kept, n, shape)
        rate = 1.0 / (3.0 * _steepness(kept))
        best = np.inf
        for done in range(1, self.getMaxIter() + 1):
            at, mean, step = weights, gradient, rate
            walk = _walked(lambda at=at, mean=mean, step=step: _SagaWalk(at, mean, step, penalty, n), keep_rows=True)
            # The residuals of a pass are written with their rows: the next pass, and every retry of it, starts from them.
            walked = checkpointed(kept.mapInArrow(walk, ROW))
            weights, change = _averaged(walked.where("weights IS NOT NULL").collect(), shape)
            gradient = gradient + change
            kept = walked.where("weights IS NULL").select("shard", "place", "x", "y", "residual")
            gap = optimality_gap(weights, gradient, penalty)
            if gap <= self.getTol():
                return weights, done
            if gap > 4 * best:
                rate /= 2
            best = min(best, gap)
        warnings.warn(f"ended after {self.getMaxIter()} passes with a gap of {gap:.2g}", RuntimeWarning, stacklevel=2)
        return weights, self.getMaxIter()


def _mean_gradient(rows: DataFrame, n: int, shape: tuple[int, int]) -> np.ndarray:
    """Mean of residual times features over all rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                residual = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                total += residual.T @ np.hstack([x, np.ones((len(x), 1))])
        i, j = (k.ravel() for k in np.indices(shape))
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "g": total.ravel()})

    found = rows.select("x", "residual").mapInArrow(partial, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
    out = np.zeros(shape)
    for r in found.collect():
        out[r["i"], r["j"]] = r["g"] / n
    return out


def _steepness(rows: DataFrame) -> float:
    """Bound of the curvature that a step of a batch meets.

    The longest row shared by the rows of a batch, or the steepest direction of all rows as the first
    ``STEEPEST_SAMPLE`` rows of the order by hash show it.  Half of it: a logistic residual changes no faster.
    """
    longest = rows.agg(F.max(F.aggregate("x", F.lit(1.0), lambda acc, v: acc + v * v))).first()[0]
    sample = np.array([r["x"] for r in rows.orderBy("place", "x").select("x").limit(STEEPEST_SAMPLE).collect()])
    sample = np.hstack([sample, np.ones((len(sample), 1))])
    return 0.5 * max(longest / BATCH, float(np.linalg.eigvalsh(sample.T @ sample / len(sample))[-1]))
