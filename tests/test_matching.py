import random
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows_of
from punctual import schemas
from punctual.checks import feeds, landing
from punctual.functions.times import gtfs_time_seconds
from punctual.operators import calendar, clipping, matching, schedule, skew
from punctual.operators.cleaning import drop_incoherent, journey_coherence
from punctual.plans.reconstruction import Reconstruction

DAY = "20260701"


# ----------------------------------------------------------------------------------- calendar, clipping


def test_active_services(spark):
    assert calendar.weekday_of(DAY) == "wednesday"
    services = spark.createDataFrame(
        [
            ("regular", "1", "0", "20260101", "20261231"),
            ("tuesdays", "0", "1", "20260101", "20261231"),
            ("expired", "1", "1", "20250101", "20260630"),
            ("last day", "1", "0", "20260101", DAY),
            ("cancelled", "1", "1", "20260101", "20261231"),
            ("both", "0", "0", "20260101", "20261231"),
        ],
        "service_id string, wednesday string, tuesday string, start_date string, end_date string",
    )
    changes = spark.createDataFrame(
        [("extra", DAY, "1"), ("cancelled", DAY, "2"), ("both", DAY, "1"), ("both", DAY, "2"), ("regular", DAY, "1"),
         ("other day", "20260702", "1")],
        "service_id string, date string, exception_type string",
    )
    got = calendar.active_services(services, changes, ["20260630", DAY])
    assert rows_of(got, "service_date", "service_id") == sorted(
        [("20260630", "tuesdays"), ("20260630", "cancelled"), ("20260630", "expired"),
         (DAY, "regular"), (DAY, "last day"), (DAY, "extra")]
    )


def test_clipping_keeps_what_touches_the_area(spark, small):
    raw = landing.raw_timetable(spark, small)
    clipped = clipping.clip_timetable(raw)
    inside = {r.stop_id for r in clipped.stops.collect()}
    assert {r.stop_id for r in clipped.stop_times.select("stop_id").distinct().collect()} <= inside
    assert clipped.trips.count() == clipped.stop_times.select("trip_id").distinct().count()
    assert clipped.routes.count() == clipped.trips.join(raw.routes, "route_id").select("route_id").distinct().count()


def test_an_agency_listed_twice_counts_once(spark):
    trips = spark.createDataFrame([("T", "R", "S", 0)], "trip_id string, route_id string, service_id string, direction_id int")
    routes = spark.createDataFrame([("R", "A", "42")], "route_id string, agency_id string, route_short_name string")
    agency = spark.createDataFrame([("A", "N2"), ("A", "N1")], "agency_id string, agency_noc string")
    assert rows_of(schedule.trip_directory(trips, routes, agency), "trip_id", "operator", "line") == [("T", "N1", "42")]
    nobody = agency.where("false")
    assert rows_of(schedule.trip_directory(trips, routes, nobody), "trip_id", "operator") == [("T", None)]


def test_packed_calls_agree_with_a_ranking(spark, small):
    feed = landing.timetable(spark, small)
    calls = schedule.located_calls(feed.stop_times, feed.stops)
    ranked = calls.withColumn("rn", F.row_number().over(Window.partitionBy("trip_id").orderBy("stop_sequence")))
    expected = rows_of(ranked.where("rn = 1"), "trip_id", "sched_sec")
    visits = schedule.first_visits(calls)
    assert rows_of(schedule.trip_origins(visits), "trip_id", "origin_sec") == expected
    per_stop = calls.withColumn(
        "rn", F.row_number().over(Window.partitionBy("trip_id", "stop_id").orderBy("stop_sequence"))
    )
    assert rows_of(schedule.with_call(visits), "trip_id", "stop_id", "stop_sequence", "sched_sec") == rows_of(
        per_stop.where("rn = 1"), "trip_id", "stop_id", "stop_sequence", "sched_sec"
    )


# --------------------------------------------------------------------------------------------- in time


@pytest.mark.parametrize("bucket", [300, 3600])
def test_nearest_in_band_agrees_with_brute_force(spark, bucket):
    rng = random.Random(5)
    left = [(rng.choice("ab"), rng.randint(0, 7000)) for _ in range(400)]
    right = [(rng.choice("ab"), rng.randint(-200, 7300), f"t{i:03}") for i in range(120)]
    expected = set()
    for key, at in set(left):
        near = [(abs(at - v), i) for k, v, i in right if k == key and abs(at - v) <= 120]
        if near:
            gap, best = min(near)
            expected.add((key, at, gap, best))
    got = matching.nearest_in_band(
        spark.createDataFrame(left, "k string, at int"),
        spark.createDataFrame(right, "k string, v int, id string"),
        ["k"], "at", "v", "id", 120, bucket,
    )
    assert rows_of(got, "k", "at", "gap", "id") == sorted(expected, key=lambda r: tuple((False, str(x)) for x in r))


def test_band_edges_and_ties(spark):
    right = spark.createDataFrame([("k", 1000, "late"), ("k", 760, "early"), ("k", 1000, "a")], "k string, v int, id string")
    left = spark.createDataFrame([("k", 880), ("k", 1120), ("k", 1121), ("k", 1000), (None, 1000)], "k string, at int")
    got = matching.nearest_in_band(left, right, ["k"], "at", "v", "id", 120)
    assert rows_of(got, "at", "id") == [(1000, "a"), (1120, "a"), (880, "a")]
    with pytest.raises(ValueError):
        matching.nearest_in_band(left, right, ["k"], "at", "v", "id", 120, bucket=240)


# -------------------------------------------------------------------------------------------- in space


def test_snap_within_agrees_with_brute_force(spark):
    rng = random.Random(7)
    near = lambda: (rng.uniform(53.3, 53.33), rng.uniform(-2.75, -2.72))
    points = spark.createDataFrame(
        [(rng.choice("ab"), i, *near()) for i in range(300)], "k string, p int, latitude double, longitude double"
    )
    sites = spark.createDataFrame(
        [(rng.choice("ab"), i, *near()) for i in range(80)], "k string, s int, stop_lat double, stop_lon double"
    )
    from punctual.functions.geo import haversine_m

    distance = haversine_m(F.col("latitude"), F.col("longitude"), F.col("stop_lat"), F.col("stop_lon"))
    expected = points.join(sites, "k").withColumn("dist_m", distance)
    for radius in (120.0, 900.0):
        got = matching.snap_within(points, sites, ["k"], radius)
        assert rows_of(got, "p", "s", "dist_m") == rows_of(expected.where(F.col("dist_m") <= radius), "p", "s", "dist_m")
        assert got.count() > 0


# ---------------------------------------------------------------------------------------- the whole way


@pytest.fixture(scope="module")
def inputs(spark, small):
    feed = landing.timetable(spark, small)
    return feed, landing.positions(spark, small).where(F.col("source_date") == DAY)


def events_of(feed, positions, **kw):
    return Reconstruction(feed, positions, [DAY], **kw)


COLUMNS = ["trip_id", "vehicle_ref", "origin_aimed_departure", "stop_id", "stop_sequence", "ping_sec", "delay_min"]


@pytest.fixture(scope="module")
def baseline(inputs):
    return rows_of(events_of(*inputs).delay_events, *COLUMNS)


def test_agrees_with_brute_force(inputs, baseline):
    """Every ping against every call of its journey's trip, in plain Python."""
    from math import asin, cos, floor, radians, sin, sqrt

    run = events_of(*inputs)
    calls = {}
    for c in run.calls.collect():
        order = (-1 if c.stop_sequence is None else c.stop_sequence, c.sched_sec)
        known = calls.setdefault(c.trip_id, {})
        if c.stop_id not in known or order < known[c.stop_id][0]:
            known[c.stop_id] = (order, c.stop_sequence, c.sched_sec, c.stop_lat, c.stop_lon)
    trip_of = {tuple(r[k] for k in matching.OBSERVED_KEY): r.trip_id for r in run.pinned.collect()}
    best = {}
    for p in run.pings.collect():
        trip = trip_of.get(tuple(p[k] for k in matching.OBSERVED_KEY))
        for stop, (_, sequence, due, lat, lon) in calls.get(trip, {}).items():
            up, along = radians(lat - p.latitude) / 2, radians(lon - p.longitude) / 2
            metres = 2 * 6_371_000 * asin(sqrt(sin(up) ** 2 + cos(radians(p.latitude)) * cos(radians(lat)) * sin(along) ** 2))
            if metres <= 120:
                key = (trip, p.vehicle_ref, p.origin_aimed_departure, stop)
                seen = (floor(metres * 1e6 + 0.5), p.ping_sec, sequence, due)
                if key not in best or seen[:2] < best[key][:2]:
                    best[key] = seen
    journeys = {}
    for key, (_, at, sequence, due) in best.items():
        if -900 <= at - due <= 5400:
            journeys.setdefault(key[:3], []).append((key[3], sequence, at, (at - due) / 60))
    expected = []
    for journey, events in journeys.items():
        delays = [e[3] for e in events]
        n, middle = len(delays), sum(delays) / len(delays)
        if n < 3 or sum((d - middle) ** 2 for d in delays) <= 36 * (n - 1) + 1e-9:
            expected += [(*journey, *e) for e in events]
    assert sorted(expected, key=str) == sorted(baseline, key=str) and len(expected) > 800


def test_columns_of_the_event_table(inputs):
    assert events_of(*inputs).delay_events.columns == schemas.EVENT_COLUMNS


def test_order_and_copies_do_not_matter(inputs, baseline):
    feed, positions = inputs
    shuffled = positions.union(positions).repartition(7, "longitude").orderBy(F.rand(3))
    mixed = replace(feed, stop_times=feed.stop_times.orderBy(F.rand(4)), trips=feed.trips.orderBy(F.rand(5)))
    assert rows_of(events_of(mixed, shuffled).delay_events, *COLUMNS) == baseline


def test_a_minute_later_is_a_minute_more(spark, inputs, small):
    feed, positions = inputs
    at = F.try_to_timestamp("recorded_at") + F.expr("interval 60 seconds")
    late = positions.withColumn("recorded_at", F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")))
    first = {r[:4]: r for r in rows_of(events_of(feed, positions).events, *COLUMNS)}
    second = {r[:4]: r for r in rows_of(events_of(feed, late).events, *COLUMNS)}
    both = first.keys() & second.keys()
    assert len(both) > 900
    assert all(second[k][-1] == pytest.approx(first[k][-1] + 1.0) for k in both)


def test_several_days_in_one_run(spark, small, baseline):
    feed, positions = landing.timetable(spark, small), landing.positions(spark, small)
    together = Reconstruction(feed, positions, feeds.SERVICE_DATES).delay_events
    assert rows_of(together.where(F.col("service_date") == DAY), *COLUMNS) == baseline
    apart = [Reconstruction(feed, positions, [d]).delay_events for d in feeds.SERVICE_DATES]
    assert rows_of(together) == rows_of(apart[0].unionByName(apart[1]))


def test_hot_journey_is_sliced_without_changing_the_result(spark, inputs):
    feed, positions = inputs
    # One bus reports a third of all pings.
    bus = positions.where("vehicle_ref = 'V4'")
    copies = bus.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(800)))).drop("copy").repartition(64)
    skewed = positions.unionByName(copies)
    run = events_of(feed, skewed)
    hot = skew.hot_keys(run.journeys, matching.OBSERVED_KEY, slice_rows=100)
    sizes = {r.origin_aimed_departure: r.n for r in run.journeys.collect() if r.n > 100}
    assert hot is not None and hot.count() >= len(sizes) > 0 and hot.agg(F.max("slices")).first()[0] == -(-max(sizes.values()) // 100)
    salted = skew.salt_rows(run.pings, hot, matching.OBSERVED_KEY)
    assert salted.count() == run.pings.count()
    slices = salted.where("vehicle_ref = 'V4'").groupBy("salt").count()
    assert slices.count() > 20 and slices.agg(F.max("count")).first()[0] < 400
    plain = matching.snap_candidates(run.pings, run.pinned, run.visits, None)
    assert rows_of(matching.snap_candidates(run.pings, run.pinned, run.visits, hot)) == rows_of(plain)
    assert skew.hot_keys(run.journeys, matching.OBSERVED_KEY) is None
    assert rows_of(run.delay_events, *COLUMNS) == rows_of(events_of(feed, positions).delay_events, *COLUMNS)


def test_a_filter_of_members_keeps_every_member(spark):
    rows = spark.range(20_000).select((F.col("id") % 5000).cast("string").alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("b"), F.col("id").alias("v"))
    members = rows.where("v % 11 = 0").select("a", "b").distinct()
    inside = rows.join(members, (rows.a == members.a) & rows.b.eqNullSafe(members.b), "left_semi")
    kept = skew.possible_members(rows, members, ["a", "b"])
    assert kept.columns == rows.columns
    assert inside.exceptAll(kept).count() == 0
    others = rows.count() - inside.count()
    assert kept.count() - inside.count() < others / 8
    assert skew.possible_members(rows, members.where("false"), ["a", "b"]).count() == 0
    assert skew.possible_members(rows, members, ["a", "b"], max_words=4) is rows


def test_evenly_spread_keys_are_left_alone(spark):
    sizes = spark.range(5000).select(F.col("id").alias("k"), F.lit(7).cast("bigint").alias("n"))
    assert skew.hot_keys(sizes, ["k"]) is None
    assert skew.hot_keys(sizes.where("false"), ["k"]) is None


def test_midnight_is_not_wrapped(spark):
    text = spark.createDataFrame([("24:10:00",)], "t string")
    assert text.select(gtfs_time_seconds(F.col("t"))).first()[0] == 87_000


# ------------------------------------------------------------------------------------------- coherence


def test_coherence_rule(spark):
    def journey(trip, delays, vehicle="V"):
        return [("20260701", trip, vehicle, "o", float(d)) for d in delays]

    events = spark.createDataFrame(
        journey("steady", [10, 11, 12]) + journey("wild", [0, 40, 5]) + journey("short", [0, 60])
        + journey("limit", [0, 6, 12]) + journey("nobody", [1, 1, 1], None),
        "service_date string, trip_id string, vehicle_ref string, origin_aimed_departure string, delay_min double",
    )
    verdict = {r.trip_id: r for r in journey_coherence(events).collect()}
    assert {k for k, r in verdict.items() if not r.coherent} == {"wild"}
    assert verdict["limit"].std_min == pytest.approx(6.0)
    kept = {r.trip_id for r in drop_incoherent(events).collect()}
    assert kept == {"steady", "short", "limit"}
