"""Grouped reports over delay events or the star schema.

A group with little support says nothing, so every report has a minimum number of events. Where a report
keeps the first k rows, the group's own columns break ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.measures import delay_seconds, is_on_time, mean_delay, on_time_pct, round_half_away
from punctual.functions.times import sched_hour
from punctual.settings import (
    MAX_STOP_SEQUENCE,
    MIN_EVENTS_CELL,
    MIN_EVENTS_HOUR,
    MIN_EVENTS_LINE,
    MIN_EVENTS_OPERATOR,
    MIN_EVENTS_OPERATOR_LINE,
    MIN_EVENTS_STOP,
    MIN_EVENTS_STOP_SEQUENCE,
    RELIABILITY_TARGET_PCT,
)


def _mean(digits: int = 2):
    return round_half_away(mean_delay(F.col("delay_min")), digits).alias("mean_delay")


def _on_time(digits: int = 1):
    return round_half_away(on_time_pct(F.col("delay_min")), digits).alias("on_time_pct")


def _events():
    return F.count(F.lit(1)).alias("events")


def _supported(report: DataFrame, min_events: int) -> DataFrame:
    return report.where(F.col("events") >= min_events)


def headline_metrics(fact: DataFrame, target_pct: float = RELIABILITY_TARGET_PCT) -> DataFrame:
    """One row: events, mean delay, share on time, operators, lines, and the gap to the target.

    Events are reduced to whole-number sums per operator and line first; the distinct counts see only those.
    """
    seconds = delay_seconds(F.col("delay_min"))
    per_line = fact.groupBy("operator", "line").agg(
        F.count(F.lit(1)).alias("n"), F.count("delay_min").alias("known"), F.sum(seconds).alias("s"),
        F.count_if(is_on_time(F.col("delay_min"))).alias("k"),
    )
    known = F.nullif(F.sum("known"), F.lit(0))
    return per_line.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        round_half_away(F.sum("s") / 60.0 / known, 2).alias("mean_delay"),
        round_half_away(F.lit(100.0) * F.sum("k") / known, 1).alias("on_time_pct"),
        F.count_distinct("operator").alias("operators"),
        F.count_distinct("line").alias("lines"),
    ).withColumn("gap_to_target", round_half_away(F.col("on_time_pct") - F.lit(target_pct), 1))


def operator_summary(
    fact: DataFrame, dim_operator: DataFrame, min_events: int = MIN_EVENTS_OPERATOR
) -> DataFrame:
    """Per operator with its name, most reliable first. Names join the finished groups, not the events."""
    groups = _supported(fact.groupBy("operator").agg(_events(), _mean(), _on_time()), min_events)
    return (
        groups.join(dim_operator, "operator")
        .select("operator", "operator_name", "events", "mean_delay", "on_time_pct")
        .orderBy(F.desc("on_time_pct"), "operator")
    )


def operator_mean_named(fact: DataFrame, dim_operator: DataFrame) -> DataFrame:
    """Mean delay per named operator, worst first."""
    return (
        fact.groupBy("operator").agg(_events(), _mean())
        .join(dim_operator, "operator")
        .select("operator", "operator_name", "events", "mean_delay")
        .orderBy(F.desc("mean_delay"), "operator")
    )


def line_summary(
    fact: DataFrame, operator: str, min_events: int = MIN_EVENTS_LINE, limit: int | None = None
) -> DataFrame:
    """Per line of one operator, worst first; at most `limit` lines if given."""
    lines = (
        _supported(
            fact.where(F.col("operator") == F.lit(operator)).groupBy("line").agg(_events(), _mean(), _on_time()),
            min_events,
        ).orderBy(F.desc("mean_delay"), "line")
    )
    return lines if limit is None else lines.limit(limit)


def delay_by_hour(
    fact: DataFrame, operator: str | None = None, min_events: int = MIN_EVENTS_HOUR
) -> DataFrame:
    """Profile over the scheduled hour, of all operators (`None`) or one."""
    if operator is not None:
        fact = fact.where(F.col("operator") == F.lit(operator))
    hours = fact.groupBy(sched_hour(F.col("sched_sec")).alias("sched_hour")).agg(_events(), _mean())
    return _supported(hours, min_events).orderBy("sched_hour")


def worst_stops(
    fact: DataFrame, dim_stop: DataFrame, operator: str, limit: int = 15, min_events: int = MIN_EVENTS_STOP
) -> DataFrame:
    """Stops (by name and position along the trip) where one operator is latest.

    Events are added up per stop id first, so that names join far fewer rows; stops that share a name are
    then added together.
    """
    sec = F.round(F.col("delay_min") * 60.0).cast("bigint")
    per_stop = (
        fact.where(F.col("operator") == F.lit(operator))
        .groupBy("stop_id", "stop_sequence")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(sec).alias("_s"))
    )
    total = F.sum("_s") / F.lit(60.0) / F.sum("_n")
    named = (
        per_stop.join(dim_stop.select("stop_id", "stop_name"), "stop_id")
        .groupBy("stop_name", "stop_sequence")
        .agg(F.sum("_n").alias("events"), round_half_away(total, 2).alias("mean_delay"))
    )
    return (
        _supported(named, min_events)
        .orderBy(F.desc("mean_delay"), "stop_name", "stop_sequence")
        .limit(limit)
    )


def least_reliable_lines(
    fact: DataFrame, min_events: int = MIN_EVENTS_OPERATOR_LINE, limit: int = 20
) -> DataFrame:
    lines = fact.groupBy("operator", "line").agg(_events(), _mean(), _on_time())
    return _supported(lines, min_events).orderBy(F.desc("mean_delay"), "operator", "line").limit(limit)


def delay_by_operator(
    fact: DataFrame, min_events: int = MIN_EVENTS_OPERATOR, limit: int = 15
) -> DataFrame:
    """The operators with the highest mean delay."""
    groups = fact.groupBy("operator").agg(mean_delay(F.col("delay_min")).alias("mean_delay"), _events())
    return _supported(groups, min_events).orderBy(F.desc("mean_delay"), "operator").limit(limit)


def delay_by_stop_sequence(
    events: DataFrame,
    max_sequence: int = MAX_STOP_SEQUENCE,
    min_events: int = MIN_EVENTS_STOP_SEQUENCE,
) -> DataFrame:
    """Mean delay by position along the trip."""
    positions = (
        events.where(F.col("stop_sequence") <= max_sequence)
        .groupBy("stop_sequence")
        .agg(mean_delay(F.col("delay_min")).alias("mean_delay"), _events())
    )
    return _supported(positions, min_events).orderBy("stop_sequence")


def delay_by_cell(
    events: DataFrame, digits: int = 2, min_events: int = MIN_EVENTS_CELL
) -> DataFrame:
    """Mean delay on a map grid of coordinates rounded to `digits` decimals."""
    cells = events.groupBy(
        round_half_away(F.col("stop_lat"), digits).alias("lat"),
        round_half_away(F.col("stop_lon"), digits).alias("lon"),
    ).agg(mean_delay(F.col("delay_min")).alias("mean_delay"), _events())
    return _supported(cells, min_events)


def events_lookup(
    fact: DataFrame, dim_stop: DataFrame, operator: str, service_date: str
) -> DataFrame:
    """All events of one operator on one date. The values are data, whatever they look like."""
    return (
        fact.where((F.col("operator") == F.lit(operator)) & (F.col("service_date") == F.lit(service_date)))
        .join(dim_stop.select("stop_id", "stop_name"), "stop_id")
        .select("line", "trip_id", "stop_name", "stop_sequence", "delay_min")
        .orderBy("trip_id", "stop_sequence")
    )


def preview(events: DataFrame, n: int = 8) -> DataFrame:
    """The first rows in a fixed order, to look at."""
    return (
        events.orderBy("service_date", "operator", "line", "trip_id", "stop_sequence", "vehicle_ref", "origin_aimed_departure")
        .select("operator", "line", "trip_id", "stop_sequence", "dist_m", "delay_min")
        .limit(n)
    )
