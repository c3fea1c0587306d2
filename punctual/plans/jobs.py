"""The jobs a deployment runs, in this order: timetable, positions, delay events, star schema, models.

Each reads what the one before has stored and can be run again on its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from punctual.models.regression import compare_models
from punctual.operators import profiling, quality, reliability, star
from punctual.operators.clipping import clip_timetable
from punctual.plans.reconstruction import Reconstruction
from punctual.plans.shared import stage_tables
from punctual.settings import GREATER_MANCHESTER, Area
from punctual.sources import positions as position_source
from punctual.sources import sinks
from punctual.sources.timetable import Timetable, read_silver_timetable, read_timetable


@dataclass(frozen=True)
class Lake:
    """Where things are: raw feeds and the tables made of them."""

    root: str

    @property
    def raw_timetable(self) -> str:
        return f"{self.root}/raw/timetable"

    @property
    def raw_positions(self) -> str:
        return f"{self.root}/raw/positions"

    @property
    def timetable(self) -> str:
        return f"{self.root}/silver/timetable"

    @property
    def positions(self) -> str:
        return f"{self.root}/silver/positions"

    @property
    def delay_events(self) -> str:
        return f"{self.root}/silver/delay_events"

    @property
    def star(self) -> str:
        return f"{self.root}/gold/star"

    @property
    def model_comparison(self) -> str:
        return f"{self.root}/gold/model_comparison"


def ingest_timetable(spark: SparkSession, lake: Lake, area: Area = GREATER_MANCHESTER) -> sinks.Counts:
    """Stores the tables of the area; returns the rows of each, counted while they were written."""
    feed = clip_timetable(read_timetable(spark, lake.raw_timetable), area)
    return sinks.write_tables({f.name: getattr(feed, f.name) for f in fields(Timetable)}, lake.timetable)


def ingest_positions(
    spark: SparkSession, lake: Lake, dates: Sequence[str], sample_every_nth: int = 1, area: Area = GREATER_MANCHESTER
) -> None:
    """Loads the archives of the given days; a day loaded before is replaced, others stay."""
    archives = {date: position_source.archive_path(lake.raw_positions, date) for date in dates}
    rows = position_source.load_positions(spark, archives, sample_every_nth, area)
    sinks.replace_days(rows, lake.positions)


def compute_delay_events(spark: SparkSession, lake: Lake, dates: Sequence[str]) -> None:
    """Works out the events of the given days; those of other days stay as they are."""
    feed = read_silver_timetable(spark, lake.timetable)
    positions = position_source.read_positions(spark, lake.positions)
    run = Reconstruction(feed, positions, dates, stage_tables(spark))
    sinks.replace_delay_events(run.delay_events, lake.delay_events, dates)


def star_tables(events: DataFrame, feed: Timetable) -> dict[str, DataFrame]:
    """Dimensions first: the order in which they are to be loaded."""
    return {
        "dim_operator": star.dim_operator(events, feed.agency),
        "dim_stop": star.dim_stop(events, feed.stops),
        "fact_delay_event": star.fact_delay_event(events),
    }


STAR_NOT_NULL = {"fact_delay_event": ["service_date", "operator", "delay_min"]}


def star_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    dim_operator, dim_stop, fact = (tables[t] for t in ("dim_operator", "dim_stop", "fact_delay_event"))
    return quality.pk_violations(
        {
            "dim_operator.operator": (dim_operator, ["operator"]),
            "dim_stop.stop_id": (dim_stop, ["stop_id"]),
            "fact_delay_event.event_id": (fact, ["event_id"]),
        }
    ).union(
        quality.fk_violations(
            {
                "fact_delay_event.operator": (fact, "operator", dim_operator, "operator"),
                "fact_delay_event.stop_id": (fact, "stop_id", dim_stop, "stop_id"),
            }
        )
    )


def star_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared constraints of the star schema, one row each."""
    required = {name: (tables[name], columns) for name, columns in STAR_NOT_NULL.items()}
    return star_key_violations(tables).union(quality.null_violations(required))


STAR = ["dim_operator", "dim_stop", "fact_delay_event"]


def load_star(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Stores a new version of the star schema and commits it once it is whole and clean.

    Until then, and if a write or a check fails, readers see the version before. NULLs are counted while the
    tables are written; keys are checked on what was written, which is not copied again.
    """
    feed = read_silver_timetable(spark, lake.timetable)
    tables = star_tables(sinks.read_delay_events(spark, lake.delay_events), feed)
    version = sinks.new_version()
    counts = sinks.write_tables(tables, f"{lake.star}/{version}", at_once=1, not_null=STAR_NOT_NULL)
    written = {name: spark.read.parquet(f"{lake.star}/{version}/{name}") for name in STAR}
    quality.require_none({f"{t}.{c}": counts[t][c] for t, columns in STAR_NOT_NULL.items() for c in columns})
    quality.require_clean(star_key_violations(written))
    sinks.commit_version(spark, lake.star, version)
    return written


def read_star(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The star schema last committed."""
    return sinks.read_committed(spark, lake.star, STAR)


def train_models(spark: SparkSession, lake: Lake) -> DataFrame:
    comparison = compare_models(sinks.read_delay_events(spark, lake.delay_events))
    sinks.write_model_comparison(comparison, lake.model_comparison)
    return comparison


def domain_report(events: DataFrame) -> dict[str, DataFrame]:
    """The three reliability tables, one job each."""
    routes = reliability.route_cv(reliability.journey_durations(events))
    return {
        "service_reliability": reliability.service_reliability(events),
        "travel_time_variability": reliability.travel_time_variability(routes),
        "by_operator": reliability.reliability_by_operator(events),
    }


def feed_report(positions: DataFrame, feed: Timetable) -> dict[str, DataFrame]:
    return {
        "feed": profiling.feed_profile(positions),
        "join_keys": profiling.join_key_coverage(positions, feed.routes, feed.agency),
        "unmatched_operators": profiling.unmatched_operators(positions, feed.agency),
    }
