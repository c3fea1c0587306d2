"""A timetable and vehicle positions derived from the given tables by whole-number arithmetic.

The given tables hold no transit data. Parts become routes, orders trips, suppliers stops and order lines
calls; the arithmetic plants trips outside the area, services added, removed and expired, hours past
midnight, origins outside the tolerance, pings too far from a stop and journeys that do not hold together.
`oracle.py` states the same derivation in SQL, from which the expected results are computed.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.operators.skew import broadcast_within
from punctual.sources.archives import SNAPSHOT_MEMBER, file_system
from punctual.sources.timetable import Timetable

SERVICE_DATES = ["20260630", "20260701"]
# The UTC instant at which each (summer) service date starts locally.
LOCAL_MIDNIGHT = {"20260630": "2026-06-29 23:00:00", "20260701": "2026-06-30 23:00:00"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _clock_text(sec: Column) -> Column:
    hours, minutes = (sec / 3600).cast("int"), (sec / 60).cast("int") % 60
    return F.concat(F.lpad(hours.cast("string"), 2, "0"), F.lit(":"), F.lpad(minutes.cast("string"), 2, "0"), F.lit(":00"))


def utc_text(midnight: Column, sec: Column) -> Column:
    """Local second `sec` as UTC ISO text; `midnight` is a timestamp without zone."""
    moment = midnight + F.make_dt_interval(secs=sec)
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    orderkey = F.col("o_orderkey")
    return read_table(spark, sf_dir, "orders").select(
        orderkey.alias("trip_id"),
        F.col("o_custkey").alias("route_id"),
        F.col("o_orderpriority").alias("service_id"),
        (orderkey % 2).cast("int").alias("direction_id"),
        (18000 + ((orderkey * 37) % 1200) * 60).cast("int").alias("origin_sec"),
    )


# Order lines that one task takes, and rows of a table that is sent to every executor (some 60 bytes each).
TASK_ROWS = 1_000_000
SENT_ROWS = 1_000_000


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt by trip, in tasks of a bounded size: what follows per call or per trip needs no further shuffle of the calls.

    Hardly two lines share a call, so nothing is gained by an aggregate before the shuffle, which takes memory.
    """
    lines = read_table(spark, sf_dir, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, -(-lines.count() // TASK_ROWS))
    return (
        lines.select(F.col("l_orderkey").alias("trip_id"), F.col("l_linenumber").alias("stop_sequence"), "l_suppkey", "l_partkey")
        .repartition(tasks, "trip_id")
        .groupBy("trip_id", "stop_sequence")
        .agg(F.min("l_suppkey").alias("stop_id"), F.min("l_partkey").alias("pk"))
    )


def _timed_calls(calls: DataFrame, trips: DataFrame) -> DataFrame:
    due = (F.col("origin_sec") + 180 * F.col("stop_sequence")).cast("int")
    return calls.join(trips, "trip_id").withColumn("sched_sec_raw", due)


def _stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return read_table(spark, sf_dir, "supplier").select(
        key.alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        (F.lit(53.3) + ((key * 7919) % 10000) * 0.00004).alias("stop_lat"),
        (F.lit(-2.8) + ((key * 104729) % 10000) * 0.0001).alias("stop_lon"),
    )


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("route_id"),
        (F.col("p_partkey") % 25).alias("agency_id"),
        (F.col("p_size") % 10).cast("string").alias("route_short_name"),
    )


def listed_sequence() -> Column:
    """Some calls come without their place in the order."""
    missing = (F.col("trip_id") % 13 == 0) & (F.col("stop_sequence") == 2)
    return F.when(~missing, F.col("stop_sequence"))


def timetable(spark: SparkSession, sf_dir: str) -> Timetable:
    """The feed as its publisher would give it, the area not yet applied."""
    calendar = spark.createDataFrame(
        [
            ("1-URGENT", "0", "1", "20260101", "20261231"),
            ("2-HIGH", "1", "1", "20260101", "20261231"),
            ("3-MEDIUM", "1", "1", "20260101", "20261231"),
            ("4-NOT SPECIFIED", "0", "0", "20260101", "20261231"),
            ("5-LOW", "1", "1", "20250101", "20251231"),
        ],
        "service_id string, tuesday string, wednesday string, start_date string, end_date string",
    )
    calendar_dates = spark.createDataFrame(
        [
            ("4-NOT SPECIFIED", "20260701", "1"),
            ("3-MEDIUM", "20260701", "2"),
            ("5-LOW", "20260702", "1"),
        ],
        "service_id string, date string, exception_type string",
    )
    return Timetable(
        stops=_stops(spark, sf_dir),
        routes=_routes(spark, sf_dir),
        trips=_trips(spark, sf_dir).drop("origin_sec"),
        stop_times=_timed_calls(_calls(spark, sf_dir), _trips(spark, sf_dir)).select(
            "trip_id", "stop_id", listed_sequence().alias("stop_sequence"),
            _clock_text(F.col("sched_sec_raw")).alias("arrival_time"),
        ),
        calendar=calendar,
        calendar_dates=calendar_dates,
        agency=read_table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("agency_id"),
            F.concat(F.lit("OP"), F.col("n_nationkey").cast("string")).alias("agency_noc"),
            F.col("n_name").alias("agency_name"),
        ),
    )


def local_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings with their times as local seconds, which may lie outside the day."""
    # routes are hung on the trips, of which there are fewer than calls
    trips = _trips(spark, sf_dir).drop("service_id", "direction_id").join(_routes(spark, sf_dir), "route_id")
    stops = _stops(spark, sf_dir).select("stop_id", "stop_lat", "stop_lon")
    first = F.min("stop_sequence").over(Window.partitionBy("trip_id"))
    trip, pk = F.col("trip_id"), F.col("pk")
    shift = F.when(trip % 11 == 0, F.lit(200)).otherwise((trip % 5 - 2) * 40)
    noise = F.when(trip % 4 == 0, (pk * 97) % 3601 - 1800).otherwise((pk * 31) % 61 - 30)
    return (
        _timed_calls(_calls(spark, sf_dir).withColumn("first_seq", first), trips)
        .join(broadcast_within(stops, SENT_ROWS), "stop_id")
        .select(
            F.concat(F.lit("OP"), F.col("agency_id").cast("string")).alias("operator_ref"),
            F.col("route_short_name").alias("line_ref"),
            F.concat(F.lit("V"), (trip % 997).cast("string")).alias("vehicle_ref"),
            (F.col("origin_sec") + 180 * F.col("first_seq") + shift).alias("journey_origin_local_sec"),
            (F.col("sched_sec_raw") + (trip * 48271) % 1801 - 300 + noise).alias("ping_local_sec"),
            (F.col("stop_lat") + (pk % 21 - 10) * 0.0001).alias("latitude"),
            (F.col("stop_lon") + (pk % 13 - 6) * 0.0002).alias("longitude"),
        )
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position feed of both service dates, times as UTC text."""
    days = F.array(
        *(
            F.struct(F.lit(d).alias("source_date"), F.lit(LOCAL_MIDNIGHT[d]).cast("timestamp_ntz").alias("midnight"))
            for d in SERVICE_DATES
        )
    )
    return (
        local_pings(spark, sf_dir)
        .withColumn("day", F.explode(days))
        .select(
            "operator_ref", "line_ref", "vehicle_ref",
            utc_text(F.col("day.midnight"), F.col("journey_origin_local_sec")).alias("origin_aimed_departure"),
            utc_text(F.col("day.midnight"), F.col("ping_local_sec")).alias("recorded_at"),
            "latitude", "longitude",
            "day.source_date",
        )
    )


def customer_calendar(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A calendar that grows with the data: one service per customer, one exception per event."""
    n = F.count(F.lit(1))
    start = F.date_add(F.lit("2023-12-20").cast("date"), n.cast("int"))
    end = F.date_add(F.lit("2023-12-20").cast("date"), (n + F.sum("o_orderkey") % 40).cast("int"))
    weekdays = ["monday", "tuesday", "wednesday"]
    calendar = (
        read_table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("service_id"))
        .agg(F.date_format(start, "yyyyMMdd").alias("start_date"), F.date_format(end, "yyyyMMdd").alias("end_date"))
        .select(
            "*",
            *(F.when((F.col("service_id") + i) % 3 != 0, "1").otherwise("0").alias(d) for i, d in enumerate(weekdays)),
        )
    )
    exceptions = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("service_id"),
        F.date_format("ts", "yyyyMMdd").alias("date"),
        F.when(F.col("event_id") % 3 == 0, "2").otherwise("1").alias("exception_type"),
    )
    return calendar, exceptions


def repeated_snapshots(positions: DataFrame) -> DataFrame:
    """The positions as two snapshots in a row report them."""
    return positions.withColumn("snapshot_file", F.explode(F.array(F.lit("1.zip"), F.lit("2.zip"))))


ACTIVITIES_PER_DOCUMENT = 40


# A position, then an activity without a place; see `_filled`.
_JOURNEY = (
    "<VehicleActivity><RecordedAtTime>{recorded_at}</RecordedAtTime><MonitoredVehicleJourney><LineRef>{line_ref}</LineRef>"
    "<OperatorRef>{operator_ref}</OperatorRef><OriginAimedDepartureTime>{origin_aimed_departure}</OriginAimedDepartureTime>"
    "<VehicleRef>{vehicle_ref}</VehicleRef>%s</MonitoredVehicleJourney></VehicleActivity>"
)
_PLACE = "<VehicleLocation><Longitude>{longitude}</Longitude><Latitude>{latitude}</Latitude></VehicleLocation>"
_ACTIVITIES = _JOURNEY % _PLACE + _JOURNEY % ""
_OPENING = '<?xml version="1.0" encoding="UTF-8"?>\n<Siri xmlns="http://www.siri.org.uk/siri"><ServiceDelivery><VehicleMonitoringDelivery>'
_CLOSING = "</VehicleMonitoringDelivery></ServiceDelivery></Siri>"


def _prefixed(text: str) -> str:
    return re.sub(r"<(/?)(\w)", r"<\1s:\2", text).replace("xmlns=", "xmlns:s=")


def _filled(template: str, row: Column) -> Column:
    """The template with the fields of a row in place of their names."""
    texts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(row[text] if i % 2 else F.lit(text) for i, text in enumerate(texts)))


def _document(opening: str, activities: str, closing: str) -> Column:
    """One document of the rows that are collected in `rows`."""
    return F.concat(F.lit(opening), F.array_join(F.transform("rows", lambda row: _filled(activities, row)), ""), F.lit(closing))


def as_documents(positions: DataFrame) -> DataFrame:
    """The positions as XML documents of 40 each, every position followed by an activity without a place;
    then all documents again, damaged in one way or another.

    Rows are brought together before they become text, which is several times as long.
    """
    together = _numbered(positions).groupBy("source_date", "number").agg(F.collect_list("row").alias("rows"))
    return _written(together).drop("held")


def _numbered(positions: DataFrame) -> DataFrame:
    """(source_date, number of the document, row); the rows of a document come from one task, one after another."""
    places = {axis: F.col(axis).cast("string") for axis in ("longitude", "latitude")}
    row = F.struct("recorded_at", "line_ref", "operator_ref", "origin_aimed_departure", "vehicle_ref", *(c.alias(axis) for axis, c in places.items()))
    number = F.floor(F.monotonically_increasing_id() / ACTIVITIES_PER_DOCUMENT)
    return positions.select("source_date", number.alias("number"), row.alias("row"))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each document as one row. The last document of a batch waits for what the next one has of it."""
    left = None
    for batch in batches:
        if left is not None:
            batch = pa.concat_batches([left, batch])
        if not batch.num_rows:
            continue
        same = [np.asarray(c) for c in (batch.column("source_date").dictionary_encode().indices, batch.column("number"))]
        starts = np.append(0, 1 + np.flatnonzero(np.any([c[1:] != c[:-1] for c in same], axis=0)))
        left = batch.slice(starts[-1])
        if len(starts) > 1:
            yield _together(batch.slice(0, starts[-1]), starts)
    if left is not None:
        yield _together(left, np.array([0, left.num_rows]))


def _together(batch: pa.RecordBatch, bounds: np.ndarray) -> pa.RecordBatch:
    first = [batch.column(c).take(pa.array(bounds[:-1])) for c in ("source_date", "number")]
    rows = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), batch.column("row"))
    return pa.RecordBatch.from_arrays([*first, rows], ["source_date", "number", "rows"])


def _written(documents: DataFrame) -> DataFrame:
    """(source_date, held: its positions, xml) of the documents and of their damaged copies."""
    kind = F.col("number") % 5
    # tails and tags that well-formed documents may have
    variant = F.col("number") % 7
    filler = "long tail " * 1000
    tails = {1: f"<!--{filler}-->", 2: "\n" * 10_000, 3: f"<?end {filler}?>"}

    def sound(write) -> Column:
        opening, closing = write(_OPENING), write(_CLOSING)
        blank = write(_ACTIVITIES).replace("VehicleActivity>", "VehicleActivity >")
        noted = re.sub(r"(<(?:s:)?VehicleActivity)>", r"\1 note='a > b'>", write(_ACTIVITIES))
        tail = F.when(variant == 1, tails[1]).when(variant == 2, tails[2]).when(variant == 3, tails[3]).otherwise("")
        return (
            F.when(variant == 4, _document(opening, blank, closing))
            .when(variant == 5, _document(opening, noted, closing))
            .otherwise(F.concat(_document(opening, write(_ACTIVITIES), closing), tail))
        )

    well_formed = F.when(F.col("number") % 3 == 0, sound(_prefixed)).otherwise(sound(str))
    damaged = (
        F.when(kind == 0, "")
        .when(kind == 1, _document(_OPENING, _ACTIVITIES, _CLOSING[:-12]))
        .when(kind == 2, _document(_OPENING, _ACTIVITIES, _CLOSING.replace("</ServiceDelivery>", "</Service>")))
        .when(kind == 3, _document(_OPENING.replace('xmlns="http://www.siri.org.uk/siri"', 'xmlns="urn:other" was="http://www.siri.org.uk/siri"'), _ACTIVITIES, _CLOSING))
        .otherwise("this is not XML")
    )
    return documents.select("source_date", F.size("rows").alias("held"), F.explode(F.array(well_formed, damaged)).alias("xml"))


def as_archives(positions: DataFrame, directory: str, at_least: int, full: int) -> DataFrame:
    """Packs the documents of the positions as a provider would: zips of zips in the shared folder.

    Gives (source_date, archive). Nothing is shuffled: a task packs what it scans, and an archive holds `full` positions or
    more where the task has so many of a day, less than twice as many in any case. Only positions that fewer than `at_least`
    tasks scan are dealt out first, before they become text. A task that runs again writes the same archives again.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, folder = file_system(directory)
        filesystem.create_dir(folder)
        made, waiting, held, here, stream, outer = [], [], 0, None, None, None

        def begin() -> None:
            nonlocal stream, outer
            close()
            made.append((here[0], f"sirivm-{here[0]}-{here[1]}-{len(made)}.zip"))
            stream = filesystem.open_output_stream(f"{folder}/{made[-1][1]}")
            outer = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)

        def write() -> None:
            nonlocal held
            for entry in waiting:
                outer.writestr(f"{len(outer.infolist()):06}.zip", entry)
            waiting.clear()
            held = 0

        def close() -> None:
            nonlocal outer
            if outer is not None:
                outer.close()
                stream.close()
                outer = None

        def finish() -> None:
            # too few for an archive of their own go to the one before
            if waiting:
                if outer is None:
                    begin()
                write()
            close()

        for batch in batches:
            for date, part, positions, xml in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here != (date, part):
                    finish()
                    here = (date, part)
                packed = io.BytesIO()
                with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as inner:
                    inner.writestr(SNAPSHOT_MEMBER, xml)
                waiting.append(packed.getvalue())
                held += positions
                if held >= 2 * full:  # a position is in a document and in its damaged copy
                    begin()
                    write()
        finish()
        dates, paths = [date for date, _ in made], [f"{directory}/{name}" for _, name in made]
        yield pa.RecordBatch.from_arrays([pa.array(dates, pa.string()), pa.array(paths, pa.string())], ["source_date", "archive"])

    if positions.rdd.getNumPartitions() < at_least:
        order = ("source_date", *(c for c in positions.columns if c != "source_date"))
        positions = positions.repartition(at_least).sortWithinPartitions(*order)
    numbered = _numbered(positions)
    row = numbered.schema["row"].dataType.simpleString()
    documents = _written(numbered.mapInArrow(_neighbours, f"source_date string, number bigint, rows array<{row}>"))
    return documents.select("source_date", F.spark_partition_id().alias("part"), "held", F.col("xml").cast("binary")).mapInArrow(
        pack, "source_date string, archive string"
    )
