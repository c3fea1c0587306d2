"""Restricting a timetable to an area."""

from __future__ import annotations

from dataclasses import fields, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.geo import in_area
from punctual.settings import GREATER_MANCHESTER, Area
from punctual.sources.timetable import Timetable

CLIPPED = ["stops", "routes", "trips", "stop_times"]


def clip_stops(stops: DataFrame, area: Area = GREATER_MANCHESTER) -> DataFrame:
    return stops.where(in_area(F.col("stop_lat"), F.col("stop_lon"), area))


def clip_timetable(feed: Timetable, area: Area = GREATER_MANCHESTER) -> Timetable:
    """Stops in the area, calls at them, trips that make such a call, routes of such trips.

    Semi joins throughout, without hints: the id sets grow with the feed, and Spark broadcasts those that
    turn out small. Ids are made distinct first, so that a trip with a large share of all calls travels as
    one row per task.
    """
    stops = clip_stops(feed.stops, area)
    stop_times = feed.stop_times.join(stops.select("stop_id"), "stop_id", "left_semi")
    trips = feed.trips.join(stop_times.select("trip_id").distinct(), "trip_id", "left_semi")
    routes = feed.routes.join(trips.select("route_id").distinct(), "route_id", "left_semi")
    return replace(feed, stops=stops, stop_times=stop_times, trips=trips, routes=routes)


def table_counts(stages: dict[str, Timetable], tables: list[str] = CLIPPED) -> DataFrame:
    """Rows per `(table_name, stage)`, in one job."""
    known = {f.name for f in fields(Timetable)}
    counts = [
        getattr(feed, name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(stage).alias("stage"), "row_count"
        )
        for stage, feed in stages.items()
        for name in tables
        if name in known
    ]
    return reduce(DataFrame.union, counts)
