"""Matching observations to the timetable: nearest in time, then nearest in space."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual import schemas
from punctual.functions.geo import cells_within, grid_cell, haversine_m, reach_lat, reach_lon
from punctual.functions.measures import delay_minutes
from punctual.functions.times import local_clock, local_day, local_seconds, service_day
from punctual.operators.skew import possible_members, repeat_for_salts, salt_rows
from punctual.settings import (
    DELAY_MAX_MINUTES,
    DELAY_MIN_MINUTES,
    LOCAL_ZONE,
    ORIGIN_TOLERANCE_SEC,
    SNAP_RADIUS_M,
)

OBSERVED_KEY = ["service_date", "operator", "line", "origin_aimed_departure"]


def observed_pings(
    positions: DataFrame, service_dates: Sequence[str], zone: str = LOCAL_ZONE
) -> DataFrame:
    """Positions recorded on the local calendar day they are filed under, named as the timetable names
    things, with the local second of day.

    Copies of a position need no removal here: the match below keeps one ping per stop, and a copy never
    changes which. Rows without operator, line or origin can match nothing and go first.
    """
    clock = local_clock(F.col("recorded_at"), zone)
    # one day is worked out for each of the dates, and none for each row
    day = reduce(lambda rest, d: F.when(F.col("source_date") == d, service_day(F.lit(d))).otherwise(rest), service_dates, F.lit(None).cast("date"))
    return (
        positions.where(F.col("source_date").isin(*service_dates))
        .where("operator_ref is not null and line_ref is not null and origin_aimed_departure is not null")
        .where(local_day(clock) == F.unix_date(day))
        .select(
            F.col("source_date").alias("service_date"),
            F.col("operator_ref").alias("operator"),
            F.col("line_ref").alias("line"),
            "origin_aimed_departure",
            "vehicle_ref",
            local_seconds(clock).alias("ping_sec"),
            "latitude",
            "longitude",
        )
    )


def distinct_positions(positions: DataFrame) -> DataFrame:
    """Positions without the copies that consecutive snapshots hold."""
    return positions.select(
        "operator_ref", "line_ref", "origin_aimed_departure", "vehicle_ref",
        "recorded_at", "latitude", "longitude",
    ).distinct()


def observed_journeys(pings: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Distinct journeys with their number of pings `n` and the local second they were due to start, NULL
    where that time cannot be read."""
    return (
        pings.groupBy(*OBSERVED_KEY)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("journey_origin_sec", local_seconds(local_clock(F.col("origin_aimed_departure"), zone)))
    )


def nearest_in_band(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_value: str,
    right_value: str,
    right_id: str,
    tolerance: int,
    bucket: int = 3600,
) -> DataFrame:
    """For each distinct `(keys, left_value)`, the right row with equal keys whose value is closest, at most
    `tolerance` away; the smaller `right_id` wins a tie. Unmatched left rows are left out.

    Not a join: both sides are laid on one time line per key, and each left row looks one step back and
    one step ahead. The work is linear, where an equi-join with a residual condition would form all pairs
    of a key. Both sides are first reduced to one row per distinct value, and a key is split into time
    buckets (rows near an edge go to both), so a group never exceeds two rows per value of one bucket
    however hot its key is.
    """
    if bucket <= 2 * tolerance:
        raise ValueError("a bucket must be wider than the whole band")
    keys = list(keys)

    def bucket_of(value):
        return F.floor(value / bucket).cast("int")

    value, band = F.col("_v"), F.lit(tolerance)
    offered = right.select(*keys, F.col(right_value).alias("_v"), F.col(right_id).alias("_id")).withColumn(
        "_bucket", F.explode(F.sequence(bucket_of(value - band), bucket_of(value + band)))
    )
    wanted = (
        left.select(*keys, F.col(left_value).alias("_v"))
        .where(value.isNotNull())
        .withColumn("_bucket", bucket_of(value))
    )
    line = (
        offered.withColumn("_left", F.lit(0))
        .unionByName(wanted.withColumn("_left", F.lit(1)), allowMissingColumns=True)
        .groupBy(*keys, "_bucket", "_v", "_left")
        .agg(F.min("_id").alias("_id"))
    )
    # At equal times the offer (0) comes before the left row (1), which therefore finds it behind itself.
    along = Window.partitionBy(*keys, "_bucket").orderBy("_v", "_left")
    looked = (
        line.withColumn("_offer", F.when(F.col("_left") == 0, F.struct("_v", "_id")))
        .withColumn("_before", F.expr("lag(_offer) ignore nulls").over(along))
        .withColumn("_after", F.expr("lead(_offer) ignore nulls").over(along))
    )

    def as_match(side):
        gap = F.abs(F.col("_v") - side["_v"])
        return F.when(gap <= tolerance, F.struct(gap.alias("gap"), side["_id"].alias("id")))

    best = F.least(as_match(F.col("_before")), as_match(F.col("_after")))
    return (
        looked.where(F.col("_left") == 1)
        .select(*keys, F.col("_v").alias(left_value), best.alias("_best"))
        .where(F.col("_best").isNotNull())
        .select(*keys, left_value, F.col("_best.gap").alias("gap"), F.col("_best.id").alias(right_id))
    )


def pin_journeys(
    journeys: DataFrame,
    departures: DataFrame,
    tolerance: int = ORIGIN_TOLERANCE_SEC,
) -> DataFrame:
    """Attaches to each observed journey the trip of its operator and line that is due to start closest to
    the journey's own origin time. Keeps the columns of `journeys`, adds `trip_id` and `direction_id`."""
    keys = ["service_date", "operator", "line"]
    offered = departures.dropna(subset=["operator", "line"]).withColumn(
        "trip", F.struct("trip_id", "direction_id")
    )
    matched = nearest_in_band(
        journeys, offered, keys, "journey_origin_sec", "origin_sec", "trip", tolerance
    )
    return journeys.join(
        matched.select(*keys, "journey_origin_sec", "trip"), [*keys, "journey_origin_sec"]
    ).select(*journeys.columns, "trip.trip_id", "trip.direction_id")


def snap_within(
    points: DataFrame,
    sites: DataFrame,
    keys: Sequence[str],
    radius_m: float,
    cell_deg: float = 0.01,
) -> DataFrame:
    """Pairs of points (`latitude`, `longitude`) and sites (`stop_lat`, `stop_lon`) with equal keys that are
    at most `radius_m` apart, with their distance `dist_m`.

    The grid cell is part of the join key: a site is repeated for the few cells its circle touches, so only
    neighbours are compared, and the rows of one key spread over as many tasks as it has cells. A box test
    comes before the trigonometry; neither drops a pair within the radius. Sites must not lie within the
    radius of the 180th meridian or a pole.
    """
    lat_reach = F.lit(reach_lat(radius_m))
    cells = ["_cell_lat", "_cell_lon"]
    spread = (
        sites.withColumn("_reach", reach_lon(F.col("stop_lat"), radius_m))
        .withColumn("_cell_lat", F.explode(cells_within(F.col("stop_lat"), lat_reach, cell_deg)))
        .withColumn("_cell_lon", F.explode(cells_within(F.col("stop_lon"), F.col("_reach"), cell_deg)))
    )
    placed = points.withColumn("_cell_lat", grid_cell(F.col("latitude"), cell_deg)).withColumn(
        "_cell_lon", grid_cell(F.col("longitude"), cell_deg)
    )
    distance = haversine_m(F.col("latitude"), F.col("longitude"), F.col("stop_lat"), F.col("stop_lon"))
    return (
        placed.join(spread, [*keys, *cells])
        .where(
            (F.abs(F.col("latitude") - F.col("stop_lat")) <= lat_reach)
            & (F.abs(F.col("longitude") - F.col("stop_lon")) <= F.col("_reach"))
        )
        .withColumn("dist_m", distance)
        .where(F.col("dist_m") <= F.lit(float(radius_m)))
        .drop("_reach", *cells)
    )


def snap_candidates(
    pings: DataFrame,
    pinned: DataFrame,
    visits: DataFrame,
    hot: DataFrame | None = None,
    radius_m: float = SNAP_RADIUS_M,
    cell_deg: float = 0.01,
) -> DataFrame:
    """Pings of pinned journeys near a stop of the journey's trip.

    The stops are hung on the journeys first. So the pings, by far the largest table, are shuffled once, and
    a Bloom filter of the pinned journeys keeps most pings of other journeys out of that shuffle. `pinned` is
    read for it at once; give it a stored table. `hot` (see `operators.skew`) names journeys with an outsized share of all pings, which are sliced.
    """
    keys = list(OBSERVED_KEY)
    sites = pinned.select(*keys, "trip_id", "direction_id").join(visits, "trip_id")
    pings = possible_members(pings, pinned, keys)
    if hot is not None:
        pings = salt_rows(pings, hot, keys)
        sites = repeat_for_salts(sites, hot, keys)
        keys = [*keys, "salt"]
    return snap_within(pings, sites, keys, radius_m, cell_deg).drop("salt")


# A distance in whole micrometres and a second of the day share one number.
_SECONDS = 1 << 17  # more than a day has


def nearest_pings(candidates: DataFrame) -> DataFrame:
    """One row per (journey, vehicle, stop): the ping closest to the stop, the earliest of equals, and how
    many `candidates` there were.

    Distances are compared and given in whole micrometres. With the time packed into the same number the
    choice is a minimum over a bigint, which aggregates by hash and combines before the shuffle, so that a
    vehicle that stands at one stop all day arrives as one row per task. What else is known of the call and
    the stop follows from the key.
    """
    micrometres = F.floor(F.col("dist_m") * 1e6 + 0.5)
    best = F.min(micrometres * _SECONDS + F.col("ping_sec")).alias("_best")
    known = ["call", "direction_id", "stop_lat", "stop_lon"]
    return (
        candidates.groupBy(*OBSERVED_KEY, "trip_id", "vehicle_ref", "stop_id", *known)
        .agg(best, F.count(F.lit(1)).alias("candidates"))
        .select(
            *OBSERVED_KEY, "trip_id", "vehicle_ref", "stop_id",
            (F.shiftright("_best", 17) / 1e6).alias("dist_m"),
            F.pmod("_best", F.lit(_SECONDS)).cast("int").alias("ping_sec"),
            *known, "candidates",
        )
    )


def clamp_delays(
    events: DataFrame, low: float = DELAY_MIN_MINUTES, high: float = DELAY_MAX_MINUTES
) -> DataFrame:
    """Adds `delay_min` and drops implausible values; both limits belong to the range."""
    timed = events.withColumn("delay_min", delay_minutes(F.col("ping_sec"), F.col("sched_sec")))
    return timed.where(F.col("delay_min").between(low, high)).select(*schemas.EVENT_COLUMNS)
