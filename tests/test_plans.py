"""What the plans must and must not contain, so that they hold at any size."""

from pyspark.sql import functions as F

from helpers import rows_of
from punctual.checks import landing
from punctual.operators import layout, matching, reports, schedule, skew, star
from punctual.plans.reconstruction import Reconstruction
from punctual.plans.shared import shared_folder

def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_pings_are_read_narrow_and_pruned(spark, small):
    pings = matching.observed_pings(landing.positions(spark, small), ["20260701"])
    plan = plan_of(matching.observed_journeys(pings))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "source_date" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    columns = scan.split("ReadSchema: struct<")[1]
    assert "latitude" not in columns and "vehicle_ref" not in columns
    assert "IsNotNull(operator_ref)" in scan


def test_pings_are_shuffled_once(spark, small):
    run = Reconstruction(landing.timetable(spark, small), landing.positions(spark, small), ["20260701"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(matching.snap_candidates(run.pings, landing.reconstruction(spark, small).pinned, run.visits))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "latitude" in line)

    def depth(line):
        return len(line) - len(line.lstrip(" :+-*()0123456789"))

    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert sum("Exchange hashpartitioning" in line for line in above) == 1
    assert any("_cell_lat" in line and "SortMergeJoin" in line for line in above)


def test_pings_of_no_pinned_journey_are_not_shuffled(spark, small):
    run = landing.reconstruction(spark, small)
    few = run.pinned.where("pmod(xxhash64(origin_aimed_departure), 4) = 0")
    kept = skew.possible_members(run.pings, few, matching.OBSERVED_KEY)
    plan = plan_of(kept)
    assert "BroadcastHashJoin [_word" in plan and "hashpartitioning(service_date" not in plan and "getbit" in plan
    pinned = run.pings.join(few, matching.OBSERVED_KEY, "left_semi")
    assert pinned.exceptAll(kept).count() == 0
    unpinned = run.pings.count() - pinned.count()
    assert 0 < unpinned and kept.count() - pinned.count() < unpinned / 4
    assert rows_of(matching.snap_candidates(run.pings, few, run.visits)) == rows_of(run.candidates.join(few, matching.OBSERVED_KEY, "left_semi"))


def test_groups_are_combined_before_the_shuffle(spark, small):
    events = landing.all_events(spark, small)
    for report in (reports.delay_by_hour(events), reports.headline_metrics(events), reports.least_reliable_lines(events)):
        plan = plan_of(report)
        assert "partial_" in plan
        assert "TakeOrderedAndProject" in plan or "Window" not in plan


def test_filters_reach_the_files(spark, small):
    day = landing.all_events(spark, small).where("service_date = '20260701'")
    plan = plan_of(reports.line_summary(day, "OP3", 1))
    assert "EqualTo(operator,OP3)" in plan and "(service_date" in plan.split("PartitionFilters")[1]
    assert "stop_lat" not in plan


def test_event_ids_need_no_global_sort(spark, small):
    plan = plan_of(star.fact_delay_event(landing.all_events(spark, small)))
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line or "hashpartitioning(0" in line]
    assert all("plan_id" in line for line in single) and "rangepartitioning" not in plan
    assert "Window [row_number()" in plan and "hashpartitioning(_bucket" in plan


def test_shared_folder_is_the_one_named_by_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark).startswith(named.rstrip("/") if named else "/")


def test_stage_reads_back_the_same_rows(spark, small):
    run = landing.reconstruction(spark, small)
    stored = run.events
    assert "FileScan parquet" in plan_of(stored)
    plan = plan_of(matching.nearest_pings(run.candidates))
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    lazy = Reconstruction(run.feed, run.positions, run.service_dates).events
    assert stored.exceptAll(lazy).count() == 0 == lazy.exceptAll(stored).count()
    assert stored.where(F.col("delay_min").isNull()).count() == 0


def test_a_bucketed_timetable_is_not_shuffled_by_trip(spark, small):
    feed = landing.timetable(spark, small)
    calls = layout.store_bucketed(feed.stop_times, "calls_by_trip", 4, "trip_id")
    trips = layout.store_bucketed(feed.trips, "trips_by_trip", 4, "trip_id")
    visits = schedule.first_visits(schedule.located_calls(calls, feed.stops))
    assert "Exchange hashpartitioning" not in plan_of(visits)
    assert "Exchange hashpartitioning" not in plan_of(schedule.trip_origins(visits))
    joined = plan_of(calls.join(trips.hint("merge"), "trip_id"))
    assert "SortMergeJoin" in joined and "Exchange" not in joined
    assert rows_of(visits) == rows_of(schedule.first_visits(schedule.located_calls(feed.stop_times, feed.stops)))
