"""How delays are distributed, and what they go along with.

Delays are whole seconds in a limited range. Counting each second once therefore gives a small exact table
(a few thousand rows a day, however many events), from which histogram, density and quantiles follow
without a second pass over the events and without moving them anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.functions.measures import delay_seconds, round_half_away
from punctual.settings import SUMMARY_ON_TIME_MINUTES, SUMMARY_TAIL_MINUTES

FEATURES = ["delay_min", "stop_sequence", "sched_hour", "stop_lat", "stop_lon", "direction_id"]


def _ranked_seconds(events: DataFrame) -> DataFrame:
    """Each second of delay with its count `n`, the running count `cum`, the total `total` and the mean
    second `centre`."""
    counted = events.groupBy(delay_seconds(F.col("delay_min")).alias("sec")).agg(F.count(F.lit(1)).alias("n"))
    # One row per distinct second: small enough for one task by construction.
    everything = Window.partitionBy(F.lit(0))
    return (
        counted.where(F.col("sec").isNotNull())
        .withColumn("cum", F.sum("n").over(everything.orderBy("sec")))
        .withColumn("total", F.sum("n").over(everything))
        .withColumn("centre", F.sum(F.col("n") * F.col("sec")).over(everything) / F.col("total"))
    )


def _quantile(q: float) -> Column:
    """Aggregate over ranked seconds: the delay in minutes at rank ceil(q·n), an element of the data."""
    return F.min(F.when(F.col("cum") >= F.col("total") * F.lit(q), F.col("sec"))) / F.lit(60.0)


def _moment(k: int) -> Column:
    """Aggregate over ranked seconds: the k-th central moment, in minutes to the k."""
    return F.sum(F.col("n") * F.pow((F.col("sec") - F.col("centre")) / 60.0, F.lit(float(k)))) / F.sum("n")


def _mean() -> Column:
    return F.sum(F.col("n") * F.col("sec")) / F.lit(60.0) / F.sum("n")


def _sample_std() -> Column:
    n = F.sum("n")
    return F.when(n > 1, F.sqrt(_moment(2) * n / (n - 1)))


def delay_run_summary(
    events: DataFrame,
    on_time: tuple[float, float] = SUMMARY_ON_TIME_MINUTES,
    tail_min: float = SUMMARY_TAIL_MINUTES,
) -> DataFrame:
    """One row printed after a reconstruction. Its on-time window is not that of the reliability metric."""
    delay, n = F.col("sec") / F.lit(60.0), F.sum("n")
    inside = F.coalesce(F.sum(F.when(delay.between(*on_time), F.col("n"))), F.lit(0))
    beyond = F.coalesce(F.sum(F.when(delay > tail_min, F.col("n"))), F.lit(0))
    return _ranked_seconds(events).agg(
        F.coalesce(n, F.lit(0)).alias("events"),
        round_half_away(_mean(), 2).alias("mean_delay_min"),
        round_half_away(_quantile(0.5), 2).alias("median_delay_min"),
        round_half_away(_sample_std(), 2).alias("std_delay_min"),
        round_half_away(F.min(delay), 2).alias("min_delay_min"),
        round_half_away(F.max(delay), 2).alias("max_delay_min"),
        inside.alias("on_time"),
        round_half_away(F.lit(100.0) * inside / n, 1).alias("on_time_pct"),
        beyond.alias("tail"),
        round_half_away(F.lit(100.0) * beyond / n, 1).alias("tail_pct"),
    )


def describe_delay(events: DataFrame) -> DataFrame:
    """One row of descriptive statistics. Skewness and kurtosis are those of a population, kurtosis in
    excess of the normal distribution's."""
    varies = _moment(2) > 0
    stats = {
        "mean": _mean(),
        "median": _quantile(0.5),
        "std": _sample_std(),
        "skewness": F.when(varies, _moment(3) / F.pow(_moment(2), F.lit(1.5))),
        "kurtosis": F.when(varies, _moment(4) / F.pow(_moment(2), F.lit(2.0)) - 3.0),
        "q1": _quantile(0.25),
        "q3": _quantile(0.75),
        "min": F.min("sec") / F.lit(60.0),
        "max": F.max("sec") / F.lit(60.0),
    }
    return _ranked_seconds(events).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *(round_half_away(value, 3).alias(name) for name, value in stats.items()),
    )


def seconds_counted(events: DataFrame, low_min: float, high_min: float, by: Sequence[str] = ()) -> DataFrame:
    """Events per whole second of delay within [low, high] minutes, per group."""
    return (
        events.where(F.col("delay_min").between(low_min, high_min))
        .groupBy(*by, delay_seconds(F.col("delay_min")).alias("sec"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def delay_histogram(
    events: DataFrame, low_min: float = -10.0, high_min: float = 40.0, bins: int = 50
) -> DataFrame:
    """Equal bins between the smallest and the largest value seen in the range; the last one is closed."""
    counted = seconds_counted(events, low_min, high_min)
    # One row per second of the range: small enough for one task by construction.
    everything = Window.partitionBy(F.lit(0))
    placed = (
        counted.withColumn("lo", F.min("sec").over(everything))
        .withColumn("hi", F.max("sec").over(everything))
        .withColumn("width", F.greatest(F.col("hi") - F.col("lo"), F.lit(1)))
        .withColumn(
            "bin",
            F.least(F.floor((F.col("sec") - F.col("lo")) * F.lit(bins) / F.col("width")), F.lit(bins - 1)).cast("int"),
        )
    )
    edge = (F.col("lo") + F.col("bin") * F.col("width") / F.lit(float(bins))) / F.lit(60.0)
    return placed.groupBy("bin", edge.alias("bin_start_min")).agg(F.sum("n").alias("events"))


def delay_density(
    events: DataFrame,
    by: str = "service_date",
    low_min: float = -10.0,
    high_min: float = 30.0,
    grid: int = 200,
    cut: float = 3.0,
    common_norm: bool = True,
) -> DataFrame:
    """Gaussian kernel density per group, bandwidth by Scott's rule, on `grid` points that reach `cut`
    bandwidths beyond the data. With `common_norm` all groups together have area one.

    Exact, although it never sees a single event: equal seconds share one kernel, weighted by their count.
    """
    counted = seconds_counted(events, low_min, high_min, [by]).withColumn("x", F.col("sec") / F.lit(60.0))
    group, all_groups = Window.partitionBy(by), Window.partitionBy(F.lit(0))
    n, sec = F.col("n"), F.col("sec")
    spread = F.col("gss") - F.col("gs") * F.col("gs") / F.col("gn")
    shape = (
        counted.groupBy(by)
        .agg(
            F.sum(n).cast("double").alias("gn"),
            F.sum(n * sec).cast("double").alias("gs"),
            F.sum(n * sec * sec).cast("double").alias("gss"),
            F.min("x").alias("lo"),
            F.max("x").alias("hi"),
        )
        .where(F.col("gn") > 1)
        .withColumn("std", F.sqrt(spread / (F.col("gn") - 1)) / 60.0)
        .withColumn("bw", F.col("std") * F.pow(F.col("gn"), F.lit(-0.2)))
        .withColumn("norm", F.sum("gn").over(all_groups) if common_norm else F.sum("gn").over(group))
        .where(F.col("bw") > 0)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    )
    start, stop = F.col("lo") - cut * F.col("bw"), F.col("hi") + cut * F.col("bw")
    points = shape.select(
        by, "bw", "norm", "point",
        (start + F.col("point") * (stop - start) / F.lit(float(grid - 1))).alias("delay_min"),
    )
    z = (F.col("delay_min") - F.col("x")) / F.col("bw")
    kernel = F.exp(-0.5 * z * z) / (F.sqrt(2 * F.pi()) * F.col("bw") * F.col("norm"))
    # At most (seconds in the range) x (grid points) pairs a group, whatever the number of events.
    return (
        points.join(counted, by)
        .groupBy(by, "point", "delay_min")
        .agg(F.sum(F.col("n") * kernel).alias("density"))
    )


def feature_correlation(events: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Pearson correlation of every pair of columns in one pass, over the rows where both are known; the
    full symmetric matrix in long form."""
    pairs = list(combinations(columns, 2))
    known = {p: F.col(p[0]).isNotNull() & F.col(p[1]).isNotNull() for p in pairs}
    wide = events.agg(
        *(
            F.corr(F.when(known[p], F.col(p[0]).cast("double")), F.when(known[p], F.col(p[1]).cast("double")))
            .alias(f"{p[0]}|{p[1]}")
            for p in pairs
        ),
        *(F.when(F.min(c) < F.max(c), F.lit(1.0)).alias(f"{c}|{c}") for c in columns),
    )
    cells = F.array(
        *(
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{x}|{y}`").alias("corr"))
            for a in columns
            for b in columns
            for x, y in [(a, b) if (a, b) in known or a == b else (b, a)]
        )
    )
    return wide.select(F.inline(cells))
