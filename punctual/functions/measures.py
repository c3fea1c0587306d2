"""Delay measures shared by all reports.

Delays are whole seconds held as minutes. Sums therefore run over integers, so that a mean is the same
number whatever the order in which a cluster adds it up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctual.settings import ON_TIME_MINUTES


def delay_minutes(ping_sec: Column, sched_sec: Column) -> Column:
    return (ping_sec - sched_sec) / F.lit(60.0)


def delay_seconds(delay_min: Column) -> Column:
    return F.round(delay_min * 60.0).cast("bigint")


def mean_delay(delay_min: Column) -> Column:
    """Aggregate: mean of a delay column in minutes, by exact integer sums."""
    return F.sum(delay_seconds(delay_min)) / F.lit(60.0) / F.count(delay_min)


def is_on_time(delay_min: Column, tolerance: float = ON_TIME_MINUTES) -> Column:
    return F.abs(delay_min) <= F.lit(float(tolerance))


def on_time_pct(delay_min: Column, tolerance: float = ON_TIME_MINUTES) -> Column:
    """Aggregate: share of on-time events in percent, NULL over no rows."""
    hits = F.sum(is_on_time(delay_min, tolerance).cast("int"))
    return F.lit(100.0) * hits / F.nullif(F.count(delay_min), F.lit(0))


def round_half_away(value: Column, digits: int) -> Column:
    """Round to `digits` decimals, halves away from zero, by plain double arithmetic.

    `round` works on the decimal text of a double in some engines and on its binary value in others;
    this form gives the same number in all of them.
    """
    scale = float(10**digits)
    # Adding zero turns the -0.0 of a tiny negative value into 0.0.
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale + F.lit(0.0)


def coefficient_of_variation(mean: Column, std: Column) -> Column:
    return std / F.nullif(mean, F.lit(0.0))


def model_efficiency(rmse: Column, seconds: Column) -> Column:
    """Inverse error per second of training; NaN where no time was measured."""
    return F.when(seconds > 0, F.lit(1.0) / (rmse * seconds)).otherwise(F.lit(float("nan")))
