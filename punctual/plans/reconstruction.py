"""From a timetable and vehicle positions to delay events, all service dates in one run."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame

from punctual.operators.calendar import active_services
from punctual.operators.cleaning import drop_incoherent
from punctual.operators.matching import (
    OBSERVED_KEY,
    clamp_delays,
    nearest_pings,
    observed_journeys,
    observed_pings,
    pin_journeys,
    snap_candidates,
)
from punctual.operators.schedule import (
    departures,
    first_visits,
    located_calls,
    trip_directory,
    trip_origins,
    trip_schedule,
    with_call,
)
from punctual.operators.skew import hot_keys
from punctual.plans.shared import Stage, keep_lazy
from punctual.sources.timetable import Timetable


class Reconstruction:
    """The steps of a reconstruction, each built when it is first asked for.

    `feed` holds the stops of the area only (see `operators.clipping`). Tables that more than one later
    step reads go through `stage`: `plans.shared.stage_tables` stores them, the default keeps one lazy plan.
    """

    def __init__(
        self, feed: Timetable, positions: DataFrame, service_dates: Sequence[str], stage: Stage = keep_lazy
    ):
        self.feed = feed
        self.positions = positions
        self.service_dates = list(service_dates)
        self.stage = stage

    @cached_property
    def active(self) -> DataFrame:
        return active_services(self.feed.calendar, self.feed.calendar_dates, self.service_dates)

    @cached_property
    def directory(self) -> DataFrame:
        return trip_directory(self.feed.trips, self.feed.routes, self.feed.agency)

    @cached_property
    def calls(self) -> DataFrame:
        return located_calls(self.feed.stop_times, self.feed.stops)

    @cached_property
    def schedule(self) -> DataFrame:
        return trip_schedule(self.calls, self.directory, self.active)

    @cached_property
    def visits(self) -> DataFrame:
        return self.stage(first_visits(self.calls), "visits")

    @cached_property
    def departures(self) -> DataFrame:
        return departures(trip_origins(self.visits), self.directory, self.active)

    @cached_property
    def pings(self) -> DataFrame:
        return observed_pings(self.positions, self.service_dates)

    @cached_property
    def journeys(self) -> DataFrame:
        return self.stage(observed_journeys(self.pings), "journeys")

    @cached_property
    def pinned(self) -> DataFrame:
        # Neither of the two needs the other, so their jobs may share the cluster.
        with ThreadPoolExecutor(2) as pool:
            list(pool.map(lambda name: getattr(self, name), ("visits", "journeys")))
        return self.stage(pin_journeys(self.journeys, self.departures), "pinned")

    @cached_property
    def candidates(self) -> DataFrame:
        hot = hot_keys(self.journeys, OBSERVED_KEY)
        return snap_candidates(self.pings, self.pinned, self.visits, hot)

    @cached_property
    def snapped(self) -> DataFrame:
        return self.stage(with_call(nearest_pings(self.candidates)), "snapped")

    @cached_property
    def events(self) -> DataFrame:
        return clamp_delays(self.snapped)

    @cached_property
    def delay_events(self) -> DataFrame:
        return drop_incoherent(self.events)
