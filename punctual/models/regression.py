"""Fitting, evaluating and comparing delay models against a mean-predicting baseline."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import chain
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.measures import mean_delay, model_efficiency, round_half_away
from punctual.models.features import TARGET, add_derived_features, feature_pipeline, time_split
from punctual.schemas import MODEL_COMPARISON
from punctual.settings import MODEL_FOLDS, MODEL_PARALLELISM, MODEL_SEED


def regression_metrics(
    predictions: DataFrame, by: Sequence[str] = (), label: str = TARGET, prediction: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and R² in one aggregate, per group if asked. R² is NULL where the label never varies."""
    y, p = F.col(label), F.col(prediction)
    error = y - p
    total = F.var_pop(y)
    return predictions.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(total > 0, F.lit(1.0) - F.avg(error * error) / total).alias("r2"),
    )


def predict_mean(train: DataFrame, test: DataFrame) -> DataFrame:
    """The baseline: every prediction is the mean of the training day, a scalar subquery of the plan."""
    return test.withColumn("prediction", train.agg(mean_delay(F.col(TARGET))).scalar())


def candidates(seed: int = MODEL_SEED) -> list[tuple[str, Estimator, list]]:
    """Name, estimator and grid of each model. A grid must be built from the params of the very instance:
    one built from the class is silently ignored."""
    common = {"labelCol": TARGET, "featuresCol": "features"}
    linear = LinearRegression(**common)
    forest = RandomForestRegressor(numTrees=30, seed=seed, **common)
    boosted = GBTRegressor(maxIter=30, seed=seed, **common)
    return [
        ("LinearRegression", linear, ParamGridBuilder().addGrid(linear.regParam, [0.0, 0.1]).build()),
        ("RandomForest", forest, ParamGridBuilder().addGrid(forest.maxDepth, [5, 8]).build()),
        ("GBTRegressor", boosted, ParamGridBuilder().addGrid(boosted.maxDepth, [5]).build()),
    ]


@dataclass
class Folds:
    """Training rows as features, made once for all models: what each fold is fitted and judged on, and all of them."""

    parts: list[tuple[DataFrame, DataFrame]]
    whole: DataFrame
    features: PipelineModel

    def release(self) -> None:
        for part in (self.whole, *chain.from_iterable(self.parts)):
            part.unpersist()


def with_fold(rows: DataFrame, folds: int = MODEL_FOLDS, seed: int = MODEL_SEED, column: str = "fold") -> DataFrame:
    """A number of 0 to folds - 1 for each row, drawn by a digest of all its columns: the same on every cluster."""
    return rows.withColumn(column, F.pmod(F.xxhash64(F.lit(seed), *rows.columns), F.lit(folds)).cast("int"))


def folded_features(train: DataFrame, folds: int = MODEL_FOLDS, seed: int = MODEL_SEED) -> Folds:
    """Features are fitted on the rows that a fold trains on, never on those it is judged by."""
    numbered = with_fold(train, folds, seed)
    # a day stored as few files would keep cores idle; the folds are fitted side by side and share them
    tasks = max(train.rdd.getNumPartitions(), -(-train.sparkSession.sparkContext.defaultParallelism // folds))
    numbered = numbered.repartition(tasks, *train.columns).persist(StorageLevel.MEMORY_AND_DISK)
    kept = lambda fitted, rows: fitted.transform(rows).select(TARGET, "features").persist(StorageLevel.MEMORY_AND_DISK)

    def part(k: int) -> tuple[DataFrame, DataFrame]:
        inside, outside = numbered.where(F.col("fold") != k), numbered.where(F.col("fold") == k)
        fitted = feature_pipeline().fit(inside)
        return kept(fitted, inside), kept(fitted, outside)

    fitted = feature_pipeline().fit(numbered)
    with ThreadPool(folds) as pool:
        made = Folds(pool.map(part, range(folds)), kept(fitted, numbered), fitted)
        pool.map(lambda rows: rows.count(), [made.whole, *chain.from_iterable(made.parts)])
    numbered.unpersist()
    return made


@dataclass
class Selected:
    """The model of the best grid point, fitted on all training rows, and the mean RMSE of every point."""

    model: PipelineModel
    point: dict
    rmse: list[float]


def cross_validated(estimator: Estimator, grid: list, folds: Folds, parallelism: int = MODEL_PARALLELISM) -> Selected:
    """The best model of the grid by cross-validated RMSE; all grid points see the same features."""

    def error(task: tuple[dict, tuple[DataFrame, DataFrame]]) -> float:
        point, (inside, outside) = task
        return regression_metrics(estimator.fit(inside, point).transform(outside)).first()["rmse"]

    with ThreadPool(parallelism) as pool:
        # a grid of one point leaves nothing to wait for
        only = pool.apply_async(estimator.fit, (folds.whole, grid[0])) if len(grid) == 1 else None
        errors = pool.map(error, [(point, part) for point in grid for part in folds.parts], chunksize=1)
        n = len(folds.parts)
        rmse = [sum(errors[i * n : (i + 1) * n]) / n for i in range(len(grid))]
        best = grid[min(range(len(grid)), key=rmse.__getitem__)]
        fitted = estimator.fit(folds.whole, best) if only is None else only.get()
    return Selected(PipelineModel([folds.features, fitted]), best, rmse)


def _scored(name: str, predictions: DataFrame, seconds: float) -> tuple:
    return (name, *regression_metrics(predictions).first(), seconds)


def compare_models(
    events: DataFrame, models: list[tuple[str, Estimator, list]] | None = None
) -> DataFrame:
    """One row for the baseline and for each model: test error, training time, and error per second.

    Training time is that of a model's own fits, folds and grid included; features are made once for all models.
    """
    train, test = (
        part.persist(StorageLevel.MEMORY_AND_DISK) for part in time_split(add_derived_features(events))
    )
    folds = None
    try:
        started = time.perf_counter()
        train.agg(mean_delay(F.col(TARGET))).first()
        rows = [_scored("Baseline (mean)", predict_mean(train, test), time.perf_counter() - started)]
        folds = folded_features(train)
        for name, estimator, grid in candidates() if models is None else models:
            started = time.perf_counter()
            found = cross_validated(estimator, grid, folds)
            seconds = time.perf_counter() - started
            rows.append(_scored(name, found.model.transform(test), seconds))
    finally:
        if folds is not None:
            folds.release()
        train.unpersist()
        test.unpersist()
    scores = events.sparkSession.createDataFrame(
        rows, "model string, rmse double, mae double, r2 double, train_time_s double"
    )
    return (
        scores.withColumn("model_efficiency", model_efficiency(F.col("rmse"), F.col("train_time_s")))
        .select(
            "model",
            *(round_half_away(F.col(c), 4).alias(c) for c in ("rmse", "mae", "r2")),
            round_half_away(F.col("train_time_s"), 2).alias("train_time_s"),
            round_half_away(F.col("model_efficiency"), 5).alias("model_efficiency"),
        )
        .select(*MODEL_COMPARISON.fieldNames())
    )


def metrics_long(comparison: DataFrame, metrics: Sequence[str] = ("rmse", "mae")) -> DataFrame:
    """Wide to long: one row per model and metric, metric names in capitals."""
    long = comparison.unpivot(["model"], list(metrics), "metric", "minutes")
    return long.withColumn("metric", F.upper("metric"))
