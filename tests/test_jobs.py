"""The jobs from raw files to model table, on a feed written out as its publisher would."""

import zipfile
from dataclasses import fields, replace

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import rows_of
from punctual.checks import feeds, landing
from punctual.functions.geo import in_area
from punctual.models import regression
from punctual.operators import reports
from punctual.plans import jobs
from punctual.plans.reconstruction import Reconstruction
from punctual.sources import positions as position_source
from punctual.sources import sinks
from punctual.sources.timetable import Timetable
from test_sources import snapshot

DATES = ["20260630", "20260701"]
COLUMNS = ["service_date", "trip_id", "vehicle_ref", "origin_aimed_departure", "stop_id", "ping_sec", "delay_min"]


def as_text_ids(frame):
    return frame.select(
        *(F.col(c).cast("string").alias(c) if c.endswith("_id") and c != "direction_id" else F.col(c) for c in frame.columns)
    )


@pytest.fixture(scope="module")
def lake(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = jobs.Lake(str(root))
    (root / "raw" / "timetable").mkdir(parents=True)
    (root / "raw" / "positions").mkdir()
    feed = landing.raw_timetable(spark, small)
    for field in fields(Timetable):
        frame = getattr(feed, field.name).toPandas().convert_dtypes()  # keeps whole numbers beside nulls
        frame = frame[list(reversed(frame.columns))]  # feeds order their columns as they like
        frame.to_csv(root / "raw" / "timetable" / f"{field.name}.txt", index=False)
    for date in DATES:
        pings = landing.positions(spark, small).where(F.col("source_date") == date)
        documents = [r.xml for r in feeds.as_documents(pings).collect()]
        with zipfile.ZipFile(position_source.archive_path(lake.raw_positions, date), "w") as outer:
            for i, xml in enumerate(documents):
                outer.writestr(f"{i:04}.zip", snapshot(xml) if xml else b"")
    return lake


def test_from_raw_files_to_reports(spark, small, lake):
    counts = jobs.ingest_timetable(spark, lake)
    assert {t: c[sinks.ROWS] for t, c in counts.items()} == {
        f.name: spark.read.parquet(f"{lake.timetable}/{f.name}").count() for f in fields(Timetable)
    }
    jobs.ingest_positions(spark, lake, DATES)
    jobs.ingest_positions(spark, lake, DATES[:1])  # again: the day is replaced, not doubled
    stored = position_source.read_positions(spark, lake.positions)
    pings = landing.positions(spark, small).where(in_area(F.col("latitude"), F.col("longitude")))
    columns = ["source_date", "vehicle_ref", "recorded_at", "line_ref", "latitude", "longitude"]
    assert rows_of(stored, *columns) == rows_of(pings, *columns)

    jobs.compute_delay_events(spark, lake, DATES)
    events = sinks.read_delay_events(spark, lake.delay_events)
    feed = landing.timetable(spark, small)
    text_feed = replace(feed, **{f.name: as_text_ids(getattr(feed, f.name)) for f in fields(Timetable)})
    expected = Reconstruction(text_feed, pings, DATES).delay_events
    assert rows_of(events, *COLUMNS) == rows_of(expected, *COLUMNS)
    assert events.count() > 1000
    assert reports.preview(events).count() == 8

    star = jobs.load_star(spark, lake)
    assert star["fact_delay_event"].count() == events.count()
    assert {r.violations for r in jobs.star_violations(star).collect()} == {0}

    assert rows_of(jobs.read_star(spark, lake)["fact_delay_event"]) == rows_of(star["fact_delay_event"])

    linear = LinearRegression(labelCol="delay_min", featuresCol="features")
    grid = ParamGridBuilder().addGrid(linear.regParam, [0.0]).build()
    comparison = regression.compare_models(events, [("LinearRegression", linear, grid)])
    sinks.write_model_comparison(comparison, lake.model_comparison)
    assert rows_of(sinks.read_model_comparison(spark, lake.model_comparison), "model") == [
        ("Baseline (mean)",), ("LinearRegression",)
    ]


def test_a_load_that_fails_between_two_tables_shows_readers_the_version_before(spark, tmp_path):
    def tables(n):
        return {"a": spark.range(n).toDF("id"), "b": spark.range(n).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))}

    def load(some):
        version = sinks.new_version()
        counts = sinks.write_tables(some, f"{tmp_path}/{version}", at_once=1, not_null={"b": ["id"]})
        sinks.commit_version(spark, str(tmp_path), version)
        return counts

    with pytest.raises(FileNotFoundError):
        sinks.read_committed(spark, str(tmp_path), ["a"])
    assert load(tables(3)) == {"a": {"rows": 3}, "b": {"rows": 3, "id": 1}}
    broken = tables(5) | {"b": spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))}
    with pytest.raises(Exception, match="no"):
        load(broken)
    seen = sinks.read_committed(spark, str(tmp_path), ["a", "b"])
    assert {name: rows.count() for name, rows in seen.items()} == {"a": 3, "b": 3}
    assert load(tables(0)) == {"a": {"rows": 0}, "b": {"rows": 0, "id": 0}}
    assert sinks.read_committed(spark, str(tmp_path), ["b"])["b"].count() == 0
    assert {name: rows.count() for name, rows in seen.items()} == {"a": 3, "b": 3}  # a reader keeps its version


def test_counts_while_writing_take_no_further_job(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()

    def jobs_of(group, run):
        spark.sparkContext.setJobGroup(group, group)
        try:
            run()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    rows = spark.range(1000).withColumn("even", F.when(F.col("id") % 2 == 0, F.col("id")))
    plain = jobs_of("plain", lambda: rows.write.parquet(f"{tmp_path}/plain"))
    seen = {}

    def counted():
        watch = Observation()
        rows.observe(watch, F.count_if(F.col("even").isNull()).alias("n")).write.parquet(f"{tmp_path}/seen")
        seen.update(watch.get)

    assert jobs_of("counted", counted) == plain > 0
    assert seen == {"n": 500}
    assert sinks.write_tables({"t": rows}, str(tmp_path), not_null={"t": ["even"]}) == {"t": {"rows": 1000, "even": 500}}
