"""Permute, split, scale, fit and compare classifiers."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.models import classifiers
from almanac.operators.splits import exact_split
from almanac.sinks.models import load_model, save_model


def train_and_test(
    samples: DataFrame, train_size: int | float = 0.75, test_size: int | float = 0.25, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The two parts of an exact split; a row's part depends on its id only, so either can be computed again."""
    parts = exact_split(samples, "id", train_size, test_size, seed)
    return parts.where("part = 'train'").drop("part"), parts.where("part = 'test'").drop("part")


def classify(samples: DataFrame, estimator: Estimator) -> DataFrame:
    """(id, label, prediction) of the test rows."""
    train, test = train_and_test(samples)
    model = classifiers.fit_models(train, {"model": estimator})["model"]
    return classifiers.predict(model, test)


def compare_saved(samples: DataFrame, estimators: dict[str, Estimator], folder: str) -> DataFrame:
    """Fit, save, load and compare: (model, acc, n, zero_pct)."""
    train, test = train_and_test(samples)
    for name, model in classifiers.fit_models(train, estimators).items():
        save_model(model, f"{folder}/{name}")
    loaded = {name: load_model(f"{folder}/{name}") for name in estimators}
    return classifiers.compare_models(loaded, test)


def reload_check(samples: DataFrame, estimators: dict[str, Estimator], folder: str, classes: int) -> DataFrame:
    """(model, id, label, in_range, same): predictions of the test rows before saving and after loading."""
    train, test = train_and_test(samples)
    fitted = classifiers.fit_models(train, estimators)
    for name, model in fitted.items():
        save_model(model, f"{folder}/{name}")
    both = {f"{name}:{when}": model for name, pair in fitted.items() for when, model in (
        ("fitted", pair), ("loaded", load_model(f"{folder}/{name}")))}
    name, when = F.split("model", ":")[0], F.split("model", ":")[1]
    tall = classifiers.predict_all(both, test).select(name.alias("model"), when.alias("when"), "id", "label", "pred")
    at = {w: F.max(F.when(F.col("when") == w, F.col("pred"))) for w in ("fitted", "loaded")}
    return tall.groupBy("model", "id", "label").agg(
        at["loaded"].isin(*map(float, range(classes))).alias("in_range"), (at["fitted"] == at["loaded"]).alias("same")
    )


def recomputed(samples: DataFrame, estimators: dict[str, Estimator]) -> DataFrame:
    """(model, id, label, same): is the prediction the class of the largest margin by the coefficient table?"""
    train, test = train_and_test(samples)
    models = classifiers.fit_models(train, estimators)
    scaled = classifiers.predict_all(models, test).join(
        next(iter(models.values())).stages[0].transform(classifiers.with_vector(test))
        .select("id", F.posexplode(vector_to_array("scaled")).alias("feature", "x")),
        "id",
    )
    weights = classifiers.coefficients(samples.sparkSession, models)
    intercepts = classifiers.intercepts(samples.sparkSession, models)
    margins = (
        scaled.join(weights, ["model", "feature"]).groupBy("model", "id", "label", "pred", "class")
        .agg(F.sum(F.col("x") * F.col("value")).alias("margin"))
        .join(intercepts, ["model", "class"])
        .withColumn("margin", F.col("margin") + F.col("intercept"))
    )
    best = F.max_by("class", F.struct("margin", -F.col("class")))
    return margins.groupBy("model", "id", "label").agg((best == F.first("pred")).alias("same"))


def saved_scaler(samples: DataFrame, estimator: Estimator, folder: str) -> DataFrame:
    """(pos, m, sd) of the scaler inside a model that has been saved and loaded, rounded to 6 places."""
    train, _ = train_and_test(samples)
    save_model(classifiers.fit_models(train, {"model": estimator})["model"], f"{folder}/model")
    statistics = load_model(f"{folder}/model").stages[0].statistics()
    rows = samples.sparkSession.createDataFrame(statistics, "pos int, m double, sd double")
    return rows.select("pos", F.round("m", 6).alias("m"), F.round("sd", 6).alias("sd"))
