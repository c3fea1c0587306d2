import duckdb
import numpy as np
import pytest

from punctual.operators import reliability, selection


def frame_of(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("kind", ["spread", "ties", "far", "negative"])
def test_quantiles_against_a_sorted_list(spark, kind, q):
    source = np.random.default_rng(1)
    values = {
        "spread": source.random(1001), "ties": source.integers(0, 5, 400), "far": np.exp(source.normal(0, 30, 500)), "negative": source.normal(-3, 1, 10),
    }[kind]
    found = selection.quantile_disc(frame_of(spark, [*values, None]).repartition(3), "v", q, ranges=16).first().value
    assert found == sorted(values)[max(int(np.ceil(q * len(values))), 1) - 1]


def test_quantiles_of_few_values(spark):
    assert selection.quantile_disc(frame_of(spark, [None, None]), "v", 0.5).first().value is None
    assert selection.quantile_disc(frame_of(spark, [2.5]), "v", 0.5).first().value == 2.5
    assert selection.quantile_disc(frame_of(spark, [7.0] * 9), "v", 0.1).first().value == 7.0


def test_median_of_very_many_routes(spark):
    """A sketch of default accuracy is a few ranks off here."""
    routes = spark.sql("select cast(pmod(id * 48271, 50001) as double) / 50000 cv from range(50001)")
    expected = duckdb.sql("select quantile_disc((id * 48271) % 50001 / 50000, 0.5) from range(50001) r(id)").fetchall()[0][0]
    assert selection.quantile_disc(routes, "cv", 0.5).first().value == expected
    summary = reliability.travel_time_variability(routes).first()
    assert (summary.routes_assessed, summary.median_cv) == (50001, 0.5)
    plan = selection.quantile_disc(routes, "cv", 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
