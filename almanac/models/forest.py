"""Random-forest regression of a daily maximum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame

from almanac.models.caching import cached

# Feature sets and forest size.
SEASON_FEATURES = ("latitude", "longitude", "elevation", "day_of_year")
LAG_FEATURES = ("latitude", "longitude", "elevation", "yesterday_tmax")
TREES, DEPTH, SEED = 3, 4, 15


def fit_forest(
    train: DataFrame,
    features: Sequence[str] = SEASON_FEATURES,
    label: str = "tmax",
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
) -> PipelineModel:
    """SQL stage, assembler and forest as one pipeline, fitted on the needed columns only.

    Best given a stored table: a cached shuffle keeps one task per shuffle partition
    on every pass, while files give as many tasks as the data need.
    """
    needed = {label, *features} - {"day_of_year"} | ({"date"} if "day_of_year" in features else set())
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        RandomForestRegressor(
            featuresCol="features", labelCol=label, predictionCol="prediction",
            numTrees=trees, maxDepth=depth, seed=seed,
        ),
    ]
    if "day_of_year" in features:
        stages.insert(0, SQLTransformer(statement="SELECT *, dayofyear(date) AS day_of_year FROM __THIS__"))
    with cached(train.select(*sorted(needed))) as rows:
        return Pipeline(stages=stages).fit(rows)
