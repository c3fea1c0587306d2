"""Declared columns of the feeds and tables (fixed values: the field names of the two feed standards)."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}


def struct(columns: str) -> T.StructType:
    """Nullable columns from "name type, …" (`fromDDL` would need a running session at import)."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


STOPS = struct(
    "stop_id string, stop_code string, stop_name string, stop_lat double, stop_lon double, "
    "wheelchair_boarding int, location_type int, parent_station string, platform_code string"
)
ROUTES = struct(
    "route_id string, agency_id string, route_short_name string, route_long_name string, route_type int"
)
TRIPS = struct(
    "route_id string, service_id string, trip_id string, trip_headsign string, direction_id int, "
    "block_id string, shape_id string, wheelchair_accessible int, vehicle_journey_code string"
)
STOP_TIMES = struct(
    "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int, "
    "stop_headsign string, pickup_type int, drop_off_type int, shape_dist_traveled double, timepoint int"
)
CALENDAR = struct(
    "service_id string, monday string, tuesday string, wednesday string, thursday string, "
    "friday string, saturday string, sunday string, start_date string, end_date string"
)
CALENDAR_DATES = struct("service_id string, date string, exception_type string")
AGENCY = struct("agency_id string, agency_noc string, agency_name string")

TIMETABLE = {
    "stops": STOPS,
    "routes": ROUTES,
    "trips": TRIPS,
    "stop_times": STOP_TIMES,
    "calendar": CALENDAR,
    "calendar_dates": CALENDAR_DATES,
    "agency": AGENCY,
}

# Columns without which a row of the table means nothing.
REQUIRED = {
    "stops": ["stop_id"],
    "routes": ["route_id"],
    "trips": ["route_id", "trip_id"],
    "stop_times": ["trip_id", "stop_id"],
    "calendar": ["service_id", "start_date", "end_date"],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "agency": ["agency_id", "agency_noc"],
    "positions": ["recorded_at", "snapshot_file", "source_date"],
}

POSITIONS = struct(
    "recorded_at string, line_ref string, direction_ref string, operator_ref string, origin_ref string, "
    "destination_ref string, origin_aimed_departure string, dated_vehicle_journey_ref string, "
    "data_frame_ref string, vehicle_ref string, longitude double, latitude double, "
    "snapshot_file string, source_date string"
)

DELAY_EVENTS = struct(
    "service_date string, operator string, line string, direction_id int, trip_id string, "
    "vehicle_ref string, origin_aimed_departure string, stop_id string, stop_sequence int, "
    "stop_lat double, stop_lon double, sched_sec int, ping_sec int, dist_m double, delay_min double"
)
EVENT_COLUMNS = DELAY_EVENTS.fieldNames()

FACT_COLUMNS = [
    "service_date", "operator", "line", "direction_id", "trip_id",
    "stop_id", "stop_sequence", "sched_sec", "ping_sec", "delay_min",
]

JOURNEY_KEY = ["service_date", "trip_id", "vehicle_ref", "origin_aimed_departure"]

MODEL_COMPARISON = struct(
    "model string, rmse double, mae double, r2 double, train_time_s double, model_efficiency double"
)
