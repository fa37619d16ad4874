"""Scaling by mean and population deviation as a stage of a saved pipeline."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators import scaling


class Standardiser(Model, HasInputCol, HasOutputCol, DefaultParamsWritable, DefaultParamsReadable):
    """``(x - mean) / deviation``; constant features become 0."""

    mean = Param(Params._dummy(), "mean", "means of the features", TypeConverters.toListFloat)
    deviation = Param(Params._dummy(), "deviation", "population deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, mean=None, deviation=None, inputCol="features", outputCol="scaled"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def statistics(self) -> list[tuple[int, float, float]]:
        """(pos, mean, deviation) of each feature."""
        pairs = zip(self.getOrDefault(self.mean), self.getOrDefault(self.deviation), strict=True)
        return [(pos, mean, deviation) for pos, (mean, deviation) in enumerate(pairs)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = dataset.sparkSession.range(1).select(
            F.array(*map(F.lit, self.getOrDefault(self.mean))).alias("mean"),
            F.array(*map(F.lit, self.getOrDefault(self.deviation))).alias("sd"),
        )
        arrays = dataset.withColumn("__array", vector_to_array(self.getInputCol()))
        scaled = scaling.standardize(arrays, "__array", fitted, self.getOutputCol())
        return scaled.withColumn(self.getOutputCol(), array_to_vector(self.getOutputCol())).drop("__array")


def fit_standardiser(train: DataFrame, column: str = "features", out: str = "scaled") -> Standardiser:
    """One job: count, mean and variance together.  Rows without a vector do not count."""
    arrays = train.select(vector_to_array(column).alias("x"))
    fitted = scaling.fit_scaler(arrays, "x").first()
    if not fitted["n"]:
        raise ValueError("no training rows")
    return Standardiser(mean=list(fitted["mean"]), deviation=list(fitted["sd"]), inputCol=column, outputCol=out)
