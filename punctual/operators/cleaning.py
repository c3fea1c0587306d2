"""Removing journeys whose delays cannot be right."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.measures import delay_minutes, delay_seconds
from punctual.schemas import JOURNEY_KEY
from punctual.settings import MAX_JOURNEY_STD_MINUTES, MIN_STOPS_FOR_COHERENCE


def journey_coherence(
    events: DataFrame,
    max_std_minutes: float = MAX_JOURNEY_STD_MINUTES,
    min_stops: int = MIN_STOPS_FOR_COHERENCE,
) -> DataFrame:
    """Per journey: stops seen, sample standard deviation of the delay, and whether it holds together.

    The test is n·Σs² − (Σs)² ≤ limit²·n·(n−1) on whole seconds: the variance test without a rounding
    error in the sums, so the verdict cannot depend on the order of addition.
    """
    sec = delay_seconds(F.col("delay_min"))
    sums = events.groupBy(*JOURNEY_KEY).agg(
        F.count(F.lit(1)).alias("n_stops"), F.sum(sec).alias("_s"), F.sum(sec * sec).alias("_ss")
    )
    n = F.col("n_stops")
    wide = "decimal(19,0)"
    spread = (n.cast(wide) * F.col("_ss").cast(wide) - F.col("_s").cast(wide) * F.col("_s").cast(wide)).cast("double")
    pairs = n.cast("double") * (n - 1)
    limit = (max_std_minutes * 60.0) ** 2
    return sums.select(
        *JOURNEY_KEY,
        "n_stops",
        F.when(n > 1, F.sqrt(spread / pairs) / 60.0).alias("std_min"),
        ((n < min_stops) | (spread <= F.lit(limit) * pairs)).alias("coherent"),
    )


def drop_incoherent(events: DataFrame, **limits: float) -> DataFrame:
    """Events of coherent journeys. Events without a vehicle have no journey to judge and go as well."""
    keep = journey_coherence(events, **limits).where("coherent").select(*JOURNEY_KEY)
    return events.join(keep, JOURNEY_KEY, "left_semi").select(*events.columns)


def cleaning_funnel(pings: DataFrame, snapped: DataFrame, coherent: DataFrame, low: float, high: float) -> DataFrame:
    """Rows left after each stage.

    `snapped` has one row per stop with the number of its `candidates`, so three stages are counted in one
    pass over it, and the join with the pings is not run for each of them.
    """
    minutes = delay_minutes(F.col("ping_sec"), F.col("sched_sec"))
    counted = snapped.agg(
        F.coalesce(F.sum("candidates"), F.lit(0)).alias("candidates"),
        F.count(F.lit(1)).alias("nearest"),
        F.count_if(minutes.between(low, high)).alias("clamped"),
    )
    rows = F.count(F.lit(1))
    parts = [
        pings.agg(rows.alias("row_count")).select(F.lit(1).alias("step"), F.lit("pings").alias("stage"), "row_count"),
        counted.select(
            F.inline(
                F.array(
                    *(
                        F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(name).alias("row_count"))
                        for i, name in enumerate(("candidates", "nearest", "clamped"), 2)
                    )
                )
            )
        ),
        coherent.agg(rows.alias("row_count")).select(F.lit(5).alias("step"), F.lit("coherent").alias("stage"), "row_count"),
    ]
    return reduce(DataFrame.union, parts)
