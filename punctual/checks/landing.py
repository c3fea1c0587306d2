"""The feeds and the event table as stored tables, each written at first use."""

from __future__ import annotations

from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from punctual.checks import feeds
from punctual.operators.clipping import clip_stops
from punctual.plans.reconstruction import Reconstruction
from punctual.plans.shared import stage_tables, written_once
from punctual.sources.sinks import replace_days, write_delay_events, write_tables
from punctual.sources.timetable import Timetable, read_silver_timetable

DAY = "20260701"
ARCHIVES_A_DAY = 8  # at least, of a day that has so few positions that they are dealt out
ARCHIVE_ROWS = 75_000  # positions in one archive, beyond that


def raw_timetable(spark: SparkSession, sf_dir: str) -> Timetable:
    def write(path: str) -> None:
        feed = feeds.timetable(spark, sf_dir)
        write_tables({f.name: getattr(feed, f.name) for f in fields(Timetable)}, path)

    return read_silver_timetable(spark, written_once(spark, sf_dir, "timetable", write))


def timetable(spark: SparkSession, sf_dir: str) -> Timetable:
    """With the stops of the area only."""
    feed = raw_timetable(spark, sf_dir)
    return replace(feed, stops=clip_stops(feed.stops))


def _read_by_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """The schema is taken from the files, except for the partition column, which stays text."""
    schema = spark.read.parquet(path).schema
    return spark.read.schema(
        T.StructType([T.StructField(day, T.StringType()) if f.name == day else f for f in schema.fields])
    ).parquet(path)


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        replace_days(feeds.positions(spark, sf_dir), path)

    return _read_by_day(spark, written_once(spark, sf_dir, "positions", write), "source_date")


def archives(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    """The positions packed as archives in the shared folder, by service date.

    Their number follows the rows, so that no archive's directory grows with them.
    """

    def write(path: str) -> None:
        rows = positions(spark, sf_dir)
        feeds.as_archives(rows, f"{path}/packed", ARCHIVES_A_DAY, ARCHIVE_ROWS).write.parquet(f"{path}/listed")

    listed = spark.read.parquet(f"{written_once(spark, sf_dir, 'archives', write)}/listed").collect()
    return {date: sorted(r.archive for r in listed if r.source_date == date) for date in {r.source_date for r in listed}}


def reconstruction(
    spark: SparkSession, sf_dir: str, service_dates: tuple[str, ...] = (DAY,)
) -> Reconstruction:
    feed = timetable(spark, sf_dir)
    return Reconstruction(feed, positions(spark, sf_dir), service_dates, stage_tables(spark))


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay events of both service dates."""

    def write(path: str) -> None:
        write_delay_events(reconstruction(spark, sf_dir, tuple(feeds.SERVICE_DATES)).delay_events, path)

    return _read_by_day(spark, written_once(spark, sf_dir, "delay_events", write), "service_date")
