"""Scheduled calls of trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.times import gtfs_time_seconds

# A call is ordered by (stop_sequence, sched_sec); one without a sequence comes first. Both packed into one number, so that "the first call"
# is a plain min() over a bigint, which aggregates by hash and combines before the shuffle; a min() over a
# struct would sort.
_SEQUENCE_STEP = 1 << 32
_SEC_OFFSET = 1 << 31
_NO_SEQUENCE = -(1 << 31)


def _pack_call(stop_sequence: Column, sched_sec: Column) -> Column:
    place = F.coalesce(stop_sequence.cast("bigint"), F.lit(_NO_SEQUENCE).cast("bigint"))
    return place * _SEQUENCE_STEP + (sched_sec + F.lit(_SEC_OFFSET))


def _packed_sequence(call: Column) -> Column:
    return F.nullif(F.shiftright(call, 32).cast("int"), F.lit(_NO_SEQUENCE))


def _packed_sec(call: Column) -> Column:
    return (F.pmod(call, F.lit(_SEQUENCE_STEP)) - F.lit(_SEC_OFFSET)).cast("int")


def trip_directory(trips: DataFrame, routes: DataFrame, agency: DataFrame) -> DataFrame:
    """Per trip: its service, direction, line and operator (NULL where the agency is not listed).

    An agency listed twice counts once, under its first code in alphabetical order.
    """
    operators = agency.groupBy("agency_id").agg(F.min("agency_noc").alias("operator"))
    return (
        trips.select("trip_id", "route_id", "service_id", "direction_id")
        .join(
            routes.select("route_id", "agency_id", F.col("route_short_name").alias("line"))
            .join(operators, "agency_id", "left"),
            "route_id",
        )
        .select("trip_id", "service_id", "direction_id", "line", "operator")
    )


def located_calls(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Calls with a readable arrival time at one of `stops`, with the place and the second of day."""
    return (
        stop_times.select(
            "trip_id", "stop_id", "stop_sequence",
            gtfs_time_seconds(F.col("arrival_time")).alias("sched_sec"),
        )
        .where(F.col("sched_sec").isNotNull())
        .join(stops.select("stop_id", "stop_lat", "stop_lon"), "stop_id")
    )


def trip_schedule(calls: DataFrame, directory: DataFrame, active: DataFrame) -> DataFrame:
    """Scheduled stop events of the trips that run on each service date."""
    running = directory.join(active, "service_id")
    return calls.join(running, "trip_id").select(
        "service_date", "operator", "line", "direction_id", "trip_id",
        "stop_id", "stop_sequence", "stop_lat", "stop_lon", "sched_sec",
    )


def first_visits(calls: DataFrame) -> DataFrame:
    """One row per (trip, stop): the first call of the trip there.

    Sufficient for matching. A ping is equally far from all calls at a stop, and the earliest of them
    always wins.
    """
    call = F.min(_pack_call(F.col("stop_sequence"), F.col("sched_sec"))).alias("call")
    return calls.groupBy("trip_id", "stop_id", "stop_lat", "stop_lon").agg(call)


def with_call(visits: DataFrame) -> DataFrame:
    """Unpacks `call` into its two columns."""
    return visits.select(
        *(c for c in visits.columns if c != "call"),
        _packed_sequence(F.col("call")).alias("stop_sequence"),
        _packed_sec(F.col("call")).alias("sched_sec"),
    )


def trip_origins(visits: DataFrame) -> DataFrame:
    """`(trip_id, origin_sec)`: when each trip is due at the first of its stops."""
    first = visits.groupBy("trip_id").agg(F.min("call").alias("call"))
    return first.select("trip_id", _packed_sec(F.col("call")).alias("origin_sec"))


def departures(origins: DataFrame, directory: DataFrame, active: DataFrame) -> DataFrame:
    """Trip origins per service date, under the operator and line they run as."""
    return (
        origins.join(directory, "trip_id")
        .join(active, "service_id")
        .select("service_date", "operator", "line", "origin_sec", "trip_id", "direction_id")
    )
