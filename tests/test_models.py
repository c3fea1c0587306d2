import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from punctual import schemas
from punctual.checks import landing
from punctual.models import features, regression
from punctual.models.least_squares import least_squares


@pytest.fixture(scope="module")
def events(spark, small):
    return features.add_derived_features(landing.all_events(spark, small)).cache()


@pytest.fixture(scope="module")
def sample(events):
    # cached: rows that tie for the last place would otherwise change from one use to the next
    return events.orderBy("service_date", "trip_id", "vehicle_ref", "origin_aimed_departure", "stop_id").limit(2000).cache()


def test_nothing_known_afterwards_is_an_input(spark):
    used = set(features.CATEGORICAL + features.NUMERIC)
    assert features.TARGET not in used and used.isdisjoint(features.LEAKAGE)
    stages = features.feature_pipeline().getStages()
    read = {c for stage in stages for c in stage.getInputCols()}
    made = {c for stage in stages[:-1] for c in stage.getOutputCols()}
    assert read - made == used


def test_required_columns_and_complete_target(events):
    assert set(schemas.EVENT_COLUMNS) <= set(events.columns)
    assert {features.TARGET, *features.CATEGORICAL, *features.NUMERIC} <= set(events.columns)
    assert events.where(F.col(features.TARGET).isNull()).count() == 0


def test_features_fit_and_predict(sample):
    train, test = sample.randomSplit([0.7, 0.3], seed=42)
    fitted = features.feature_pipeline().fit(train)
    assert fitted.transform(train).first().features.size > len(features.NUMERIC)
    model = LinearRegression(labelCol=features.TARGET, featuresCol="features").fit(fitted.transform(train))
    predicted = model.transform(fitted.transform(test))
    assert predicted.where("prediction is null").count() == 0 and predicted.count() == test.count()


def test_unseen_categories_are_kept(sample):
    fitted = features.feature_pipeline().fit(sample.where("operator <> 'OP3'"))
    assert fitted.transform(sample.where("operator = 'OP3'")).count() == sample.where("operator = 'OP3'").count() > 0


def test_metrics_agree_with_the_evaluator(events):
    train, test = features.time_split(events)
    predicted = regression.predict_mean(train, test)
    row = regression.regression_metrics(predicted).first()
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol=features.TARGET, predictionCol="prediction", metricName=name)
        assert row[name] == pytest.approx(evaluator.evaluate(predicted), abs=1e-9)


def test_the_grid_takes_effect(sample):
    """A grid built from the class instead of the instance would fit the default depth twice."""
    forest = RandomForestRegressor(labelCol=features.TARGET, featuresCol="features", numTrees=3, seed=1)
    folds = regression.folded_features(sample, folds=2)
    for depth in (1, 4):
        grid = ParamGridBuilder().addGrid(forest.maxDepth, [depth]).build()
        best = regression.cross_validated(forest, grid, folds, parallelism=1).model.stages[-1]
        assert max(t.depth for t in best.trees) <= depth and best.getMaxDepth() == depth
    folds.release()
    for _name, estimator, grid in regression.candidates():
        assert grid and all(p.parent == estimator.uid for point in grid for p in point)


def test_comparison_table(events):
    linear = LinearRegression(labelCol=features.TARGET, featuresCol="features")
    grid = ParamGridBuilder().addGrid(linear.regParam, [0.1]).build()
    rows = regression.compare_models(events, [("LinearRegression", linear, grid)])
    assert rows.columns == schemas.MODEL_COMPARISON.fieldNames()
    assert [r.model for r in rows.collect()] == ["Baseline (mean)", "LinearRegression"]
    assert all(r.rmse >= r.mae > 0 and r.train_time_s >= 0 for r in rows.collect())


def test_folds_are_shared_and_never_see_what_they_are_judged_by(sample):
    numbered = regression.with_fold(sample, 3)
    assert sorted(r.fold for r in numbered.select("fold").distinct().collect()) == [0, 1, 2]
    assert numbered.exceptAll(regression.with_fold(sample.repartition(5), 3)).isEmpty()
    folds = regression.folded_features(sample, 3)
    assert [a.count() + b.count() for a, b in folds.parts] == [sample.count()] * 3 and folds.whole.count() == sample.count()
    # features and model of a fold, worked out apart
    inside = numbered.where("fold <> 1").drop("fold")
    outside = numbered.where("fold = 1").drop("fold")
    fitted = features.feature_pipeline().fit(inside)
    linear = LinearRegression(labelCol=features.TARGET, featuresCol="features")
    expected = regression.regression_metrics(linear.fit(fitted.transform(inside)).transform(fitted.transform(outside))).first()["rmse"]
    inside, outside = folds.parts[1]
    assert regression.regression_metrics(linear.fit(inside).transform(outside)).first()["rmse"] == pytest.approx(expected)
    grid = ParamGridBuilder().addGrid(linear.regParam, [100.0, 0.0]).build()
    found = regression.cross_validated(linear, grid, folds)
    assert found.point == grid[found.rmse.index(min(found.rmse))]
    assert found.rmse[1] == pytest.approx(sum(regression.regression_metrics(linear.fit(a).transform(b)).first()["rmse"] for a, b in folds.parts) / 3)
    folds.release()


def test_least_squares_of_two_categories(sample):
    """Predictions equal those of a solver that sees every row."""
    import numpy as np

    model, _ = least_squares(sample, features.TARGET, ["operator", "line"], ["sched_hour", "stop_lat"])
    rows = sample.withColumn("own", model.prediction()).collect()
    operators, lines = sorted({r.operator for r in rows}), sorted({r.line for r in rows})
    number = lambda x: 0.0 if x is None else float(x)
    x = np.array([
        [1.0, *(float(r.operator == o) for o in operators), *(float(r.line == v) for v in lines), number(r.sched_hour), number(r.stop_lat)] for r in rows
    ])
    fitted = x @ np.linalg.lstsq(x, np.array([r[features.TARGET] for r in rows]), rcond=None)[0]
    assert [r.own for r in rows] == pytest.approx(list(fitted), abs=1e-5)


def test_least_squares_folds_against_fits_of_their_own(sample):
    import numpy as np

    numbered = regression.with_fold(sample, 3).cache()
    _, errors = least_squares(numbered, features.TARGET, ["operator"], ["sched_hour"], ridges=(0.0, 5.0), fold="fold")
    rows = numbered.select("fold", "operator", "sched_hour", features.TARGET).collect()
    operators = sorted({r.operator for r in rows})
    design = lambda some: np.array([[1.0, *(float(r.operator == o) for o in operators), float(r.sched_hour or 0)] for r in some])
    for ridge in (0.0, 5.0):
        each = []
        for k in range(3):
            inside, outside = [r for r in rows if r.fold != k], [r for r in rows if r.fold == k]
            x, y = design(inside), np.array([r.delay_min for r in inside])
            a = x.T @ x + np.diag([0.0] + [ridge * len(inside)] * (x.shape[1] - 1))
            b = np.linalg.lstsq(a, x.T @ y, rcond=None)[0]
            each.append(np.sqrt(np.mean((design(outside) @ b - np.array([r.delay_min for r in outside])) ** 2)))
        assert errors[ridge] == pytest.approx(np.mean(each), rel=1e-6)


def test_least_squares_of_odd_tables(spark):
    frame = spark.createDataFrame([(None, 1.0, 2.0), ("a", None, 4.0), ("a", 3.0, None), ("b", 2.0, 3.0)], "c string, x double, y double")
    model, errors = least_squares(frame, "y", ["c"], ["x"])
    assert errors == {} and frame.select(model.prediction().alias("p")).where("p is null").count() == 0
    empty, _ = least_squares(frame.limit(0), "y", ["c"], ["x"])
    assert {r.p for r in frame.select(empty.prediction().alias("p")).collect()} == {0.0}
