"""Every tunable of the engine, with its default.

The numbers are fixed values: results only agree with published figures when they are exactly these.
Each is a keyword argument wherever an operator uses it.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Area:
    """A latitude/longitude box whose edges belong to it."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


GREATER_MANCHESTER = Area(lat_min=53.30, lat_max=53.65, lon_min=-2.75, lon_max=-1.90)

LOCAL_ZONE = "Europe/London"
EARTH_RADIUS_M = 6_371_000.0

ORIGIN_TOLERANCE_SEC = 120
SNAP_RADIUS_M = 120.0
DELAY_MIN_MINUTES = -15.0
DELAY_MAX_MINUTES = 90.0
MAX_JOURNEY_STD_MINUTES = 6.0
MIN_STOPS_FOR_COHERENCE = 3

ON_TIME_MINUTES = 2.0
RELIABILITY_TARGET_PCT = 85.0
CV_TARGET = 0.15
MIN_STOPS_PER_JOURNEY = 3
MIN_JOURNEYS_PER_ROUTE = 20

# The run summary after a reconstruction uses another, asymmetric window.
SUMMARY_ON_TIME_MINUTES = (-1.0, 5.99)
SUMMARY_TAIL_MINUTES = 20.0

MIN_EVENTS_OPERATOR = 500
MIN_EVENTS_HOUR = 200
MIN_EVENTS_STOP_SEQUENCE = 200
MAX_STOP_SEQUENCE = 40
MIN_EVENTS_CELL = 100
MIN_EVENTS_LINE = 50
MIN_EVENTS_OPERATOR_LINE = 100
MIN_EVENTS_STOP = 30

TRAIN_DATE = "20260630"
TEST_DATE = "20260701"
MODEL_SEED = 42
MODEL_FOLDS = 3
MODEL_PARALLELISM = 6  # fits at once; changes no result
