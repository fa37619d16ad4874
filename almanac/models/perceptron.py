"""Spark's multilayer perceptron, trained on blocks of rows that need no unpacking.

Spark's trainer keeps 128 rows to a vector and works through these one by one, with two levels of sums, for every evaluation of the
objective.  Here the rows are packed once into large arrays, kept as bytes; an evaluation is one job with a task for each core,
which sends its sum of loss and gradient to the driver.  Objective, initial weights, blocks, tolerance and cap are
those of Spark's trainer, which also checks the rows and makes the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.models.lbfgs import minimise

# Most sums that go to the driver at once, and rows worked on at once.
FAN_IN, ROWS_AT_ONCE = 64, 2048

# A block of rows: vectors, labels and shares.
Block = tuple[bytes, bytes, bytes]


class PackedPerceptron(MultilayerPerceptronClassifier):
    """``MultilayerPerceptronClassifier`` that trains on packed rows."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", layers=None, seed=None, tol=1e-6, maxIter=100):
        super().__init__(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        layers, start = list(self.getLayers()), self._without_steps(dataset).weights.toArray()
        rows = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y")
        )
        packed = rows.mapInArrow(_packer(layers[0], self.getBlockSize()), "x binary, y binary, share binary").rdd.map(
            lambda row: (bytes(row.x), bytes(row.y), bytes(row.share))
        )
        # Rows lie in as many partitions as there are cores, and their shares are those of the partitions they came in.
        blocks = packed.coalesce(dataset.sparkSession.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        try:
            n = _summed(blocks, lambda block: np.array([np.frombuffer(block[2]).sum()]))[0]

            def objective(weights: np.ndarray) -> tuple[float, np.ndarray]:
                total = _summed(blocks, _evaluator(layers, weights)) / n
                return float(total[0]), total[1:]

            weights, steps = minimise(objective, start, self.getTol(), self.getMaxIter())
        finally:
            blocks.unpersist()
        model = self._without_steps(dataset, weights)
        model._set(maxIter=self.getMaxIter())
        model.passes = steps
        return model

    def _without_steps(self, dataset: DataFrame, weights: np.ndarray | None = None) -> MultilayerPerceptronClassificationModel:
        """Spark's model of these weights, or else of the initial ones."""
        given = {self.maxIter: 0} | ({} if weights is None else {self.initialWeights: Vectors.dense(weights)})
        return super(PackedPerceptron, self.copy(given))._fit(dataset)


def _packer(width: int, block: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spark's trainer averages over each block of a partition, of which the last may be short, so its rows weigh more."""
        held, labels, size = [], [], 0

        def packed(rows: int) -> pa.RecordBatch:
            nonlocal held, labels, size
            x, y = np.concatenate(held), np.concatenate(labels)
            held, labels, size = [x[rows * width :]], [y[rows:]], len(y) - rows
            share = 1.0 / np.minimum(block, rows - np.arange(rows) // block * block)
            return pa.RecordBatch.from_pydict(
                {"x": [x[: rows * width].tobytes()], "y": [y[:rows].tobytes()], "share": [share.tobytes()]}
            )

        at_once = max(1, ROWS_AT_ONCE // block) * block
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            if len(x) != width * batch.num_rows:
                raise ValueError(f"expected vectors of {width} elements")
            held.append(x)
            labels.append(batch.column(1).to_numpy())
            size += batch.num_rows
            while size >= at_once:
                yield packed(at_once)
        if size:
            yield packed(size)

    return pack


def _summed(blocks: RDD, part: Callable[[Block], np.ndarray]) -> np.ndarray:
    """Sum over all blocks, in their order; of many partitions, groups are summed up first."""

    def of_partition(rows: Iterator[Block]) -> Iterator[np.ndarray]:
        total = None
        for row in rows:
            total = part(row) if total is None else total + part(row)
        if total is not None:
            yield total

    sums = blocks.mapPartitions(of_partition)
    found = sums.collect() if blocks.getNumPartitions() <= FAN_IN else [sums.treeReduce(np.add)]
    return sum(found[1:], found[0])


def _evaluator(layers: list[int], weights: np.ndarray) -> Callable[[Block], np.ndarray]:
    """Cross entropy of a block and after it its gradient, summed by the rows' shares; sigmoid layers and a softmax at the end."""
    matrices, at = [], 0
    for inputs, outputs in zip(layers, layers[1:], strict=False):
        matrices.append((weights[at : at + inputs * outputs].reshape(inputs, outputs), weights[at + inputs * outputs :][:outputs]))
        at += (inputs + 1) * outputs

    def evaluate(block: Block) -> np.ndarray:
        # Units by rows, worked on in place.
        values = [np.frombuffer(block[0]).reshape(-1, layers[0]).T]
        labels, share = np.frombuffer(block[1], np.int32), np.frombuffer(block[2])
        rows, sums = np.arange(len(labels)), []
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            for matrix, bias in matrices[:-1]:
                value = matrix.T @ values[-1]
                value += bias[:, None]
                np.exp(np.negative(value, out=value), out=value)
                value += 1.0
                values.append(np.reciprocal(value, out=value))
            delta = matrices[-1][0].T @ values[-1]
            delta += matrices[-1][1][:, None]
            delta -= delta.max(axis=0)
            np.exp(delta, out=delta)
            delta /= delta.sum(axis=0)
            # As in Spark's loss, a probability of 0 makes it no number, and the search steps back.
            loss = -float(share @ np.log(delta[labels, rows])) if delta.all() else float("nan")
        delta[labels, rows] -= 1.0
        delta *= share
        for (matrix, _), below in zip(reversed(matrices), reversed(values), strict=True):
            sums = [(delta @ below.T).T.ravel(), delta.sum(axis=1), *sums]
            if len(sums) < 2 * len(matrices):
                delta = matrix @ delta
                delta *= below
                delta *= 1.0 - below
        return np.concatenate([[loss], *sums])

    return evaluate
