"""Reliability of a service: share on time, and how much the duration of journeys varies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.measures import coefficient_of_variation, on_time_pct, round_half_away
from punctual.operators.selection import quantile_disc
from punctual.schemas import JOURNEY_KEY
from punctual.settings import (
    CV_TARGET,
    MIN_EVENTS_OPERATOR,
    MIN_JOURNEYS_PER_ROUTE,
    MIN_STOPS_PER_JOURNEY,
    ON_TIME_MINUTES,
    RELIABILITY_TARGET_PCT,
)


def service_reliability(
    events: DataFrame, tolerance: float = ON_TIME_MINUTES, target_pct: float = RELIABILITY_TARGET_PCT
) -> DataFrame:
    """One row: events, share on time, the target and whether it is met (NULL over no events)."""
    pct = round_half_away(on_time_pct(F.col("delay_min"), tolerance), 1)
    return (
        events.agg(F.count(F.lit(1)).alias("events"), pct.alias("on_time_pct"))
        .withColumn("target_pct", F.lit(float(target_pct)))
        .withColumn("meets_target", F.col("on_time_pct") >= F.col("target_pct"))
    )


def reliability_by_operator(
    events: DataFrame, min_events: int = MIN_EVENTS_OPERATOR, tolerance: float = ON_TIME_MINUTES
) -> DataFrame:
    """Share on time per operator, best first."""
    pct = round_half_away(on_time_pct(F.col("delay_min"), tolerance), 1)
    return (
        events.groupBy("operator")
        .agg(F.count(F.lit(1)).alias("events"), pct.alias("on_time_pct"))
        .where(F.col("events") >= min_events)
        .orderBy(F.desc("on_time_pct"), "operator")
    )


def journey_durations(events: DataFrame, min_stops: int = MIN_STOPS_PER_JOURNEY) -> DataFrame:
    """Observed duration of each journey: from its first to its last ping at a stop."""
    return (
        events.groupBy(*JOURNEY_KEY, "operator", "line", "direction_id")
        .agg(
            (F.max("ping_sec") - F.min("ping_sec")).alias("obs_duration_s"),
            F.count(F.lit(1)).alias("n_stops"),
        )
        .where((F.col("n_stops") >= min_stops) & (F.col("obs_duration_s") > 0))
    )


def route_cv(
    durations: DataFrame, min_journeys: int = MIN_JOURNEYS_PER_ROUTE, by_operator: bool = False
) -> DataFrame:
    """Coefficient of variation of the durations per line and direction.

    Operators that share a line number count as one route, unless `by_operator`. Durations are whole
    seconds, so mean and deviation come from exact sums and depend on no order of addition.
    """
    route = (["operator"] if by_operator else []) + ["line", "direction_id"]
    d, n = F.col("obs_duration_s").cast("bigint"), F.col("n_trips")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    spread = (exact("n_trips") * exact("_dd") - exact("_d") * exact("_d")).cast("double")
    return (
        durations.groupBy(*route)
        .agg(F.count(F.lit(1)).alias("n_trips"), F.sum(d).alias("_d"), F.sum(d * d).alias("_dd"))
        .where(n >= min_journeys)
        .withColumn("mean_dur", F.col("_d") / n)
        .withColumn("sd_dur", F.when(n > 1, F.sqrt(spread / (n.cast("double") * (n - 1)))))
        .drop("_d", "_dd")
        .withColumn("cv", coefficient_of_variation(F.col("mean_dur"), F.col("sd_dur")))
    )


def travel_time_variability(routes: DataFrame, target_cv: float = CV_TARGET) -> DataFrame:
    """One row over the routes of `route_cv`: how many, median variation, share that meets the target."""
    met = F.sum((F.col("cv") <= F.lit(target_cv)).cast("int"))
    return routes.agg(
        F.count(F.lit(1)).alias("routes_assessed"),
        round_half_away(quantile_disc(routes, "cv", 0.5).scalar(), 3).alias("median_cv"),
        F.lit(float(target_cv)).alias("target_cv"),
        round_half_away(F.lit(100.0) * met / F.nullif(F.count(F.lit(1)), F.lit(0)), 1).alias(
            "pct_routes_meeting_target"
        ),
    )
