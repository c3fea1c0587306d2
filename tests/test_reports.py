"""Reports against the same figures worked out row by row in plain Python."""

import random
import statistics
from collections import defaultdict
from math import floor

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from punctual.checks import landing
from punctual.operators import distributions, layout, quality, reliability, reports, star
from punctual.plans import jobs

FACT = (
    "service_date string, operator string, line string, direction_id int, trip_id string, stop_id string, "
    "stop_sequence int, sched_sec int, ping_sec int, delay_min double"
)


def made_facts(seed=11):
    """Three days, operators that share line numbers, ties of means, calls without a sequence."""
    source = random.Random(seed)
    rows = []
    for i in range(240):
        operator = source.choice(["NOR", "NOR", "SUD", "EST"])
        due = 60 * source.randrange(5 * 60, 26 * 60)
        late = source.choice([-90, -30, 0, 0, 30, 119, 120, 121, 600, 1500])
        sequence = source.choice([None, 1, 2, 3, 40, 41])
        rows.append((source.choice(["20260629", "20260630", "20260701"]), operator, str(source.randrange(4)), i % 2, f"trip-{i}",
                     source.choice(["q1", "q2", "q3"]), sequence, due, due + late, late / 60))
    for n in (1, 2):  # two lines with equal means
        rows += [("20260701", "TIE", f"t{n}", 0, f"tie-{n}-{i}", "q1", i, 36_000, 36_060, 1.0) for i in range(3)]
    return rows


def half_away(x, digits):
    scaled = abs(x) * 10**digits
    return (1 if x >= 0 else -1) * floor(scaled + 0.5) / 10**digits + 0.0


def mean(rows):
    return half_away(sum(round(r[9] * 60) for r in rows) / 60 / len(rows), 2)


def on_time(rows):
    return half_away(100 * sum(abs(r[9]) <= 2 for r in rows) / len(rows), 1)


def grouped(rows, *at):
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[i] for i in at)].append(r)
    return groups


@pytest.fixture(scope="module")
def tables(spark):
    names = [("NOR", "Northern Lines"), ("SUD", "Süd & Söhne"), ("EST", None), ("TIE", "Tied")]
    operators = spark.createDataFrame(names, "operator string, operator_name string")
    stops = spark.createDataFrame([(f"q{i}", f"Quay {i}", 53.4 + i / 100, -2.2) for i in (1, 2, 3)], "stop_id string, stop_name string, stop_lat double, stop_lon double")
    return spark.createDataFrame(made_facts(), FACT), operators, stops


def test_headline(tables):
    rows = made_facts()
    row = reports.headline_metrics(tables[0]).first()
    assert (row.events, row.operators, row.lines) == (len(rows), 4, 6)
    assert (row.mean_delay, row.on_time_pct) == (mean(rows), on_time(rows))
    assert row.gap_to_target == pytest.approx(on_time(rows) - 85)
    holed = tables[0].withColumn("delay_min", F.when(F.col("trip_id") != "trip-0", F.col("delay_min")))
    known = reports.headline_metrics(holed).first()
    assert (known.events, known.mean_delay) == (len(rows), mean([r for r in rows if r[4] != "trip-0"]))


def test_operator_summary_is_ordered_by_reliability(tables):
    fact, operators, _stops = tables
    got = [(r.operator, r.events, r.mean_delay, r.on_time_pct) for r in reports.operator_summary(fact, operators, min_events=1).collect()]
    expected = [(k[0], len(g), mean(g), on_time(g)) for k, g in grouped(made_facts(), 1).items()]
    assert got == sorted(expected, key=lambda r: (-r[3], r[0]))
    assert reports.operator_summary(fact, operators).count() == 0  # all are below the default minimum


def test_line_summary_is_limited_to_its_operator(tables):
    groups = grouped([r for r in made_facts() if r[1] == "TIE"], 2)
    got = [(r.line, r.events, r.mean_delay) for r in reports.line_summary(tables[0], "TIE", min_events=1).collect()]
    assert got == sorted((k[0], len(g), mean(g)) for k, g in groups.items())  # a tie, so by name
    assert [r.line for r in reports.line_summary(tables[0], "TIE", min_events=1, limit=1).collect()] == ["t1"]
    assert reports.line_summary(tables[0], "TIE", min_events=4).count() == 0


def test_worst_stops(tables):
    fact, _operators, stops = tables
    groups = grouped([r for r in made_facts() if r[1] == "NOR"], 5, 6)
    expected = sorted(
        ((f"Quay {k[0][1]}", k[1], len(g), mean(g)) for k, g in groups.items()),
        key=lambda r: (-r[3], r[0], -1 if r[1] is None else r[1]),
    )
    got = [tuple(r) for r in reports.worst_stops(fact, stops, "NOR", limit=7, min_events=1).collect()]
    assert got == expected[:7]


def test_delay_by_hour(tables):
    fact = tables[0]
    for operator in (None, "SUD"):
        rows = [(*r, r[7] // 3600 % 24) for r in made_facts() if operator in (None, r[1])]
        got = [tuple(r) for r in (reports.delay_by_hour(fact, operator, 2) if operator else reports.delay_by_hour(fact, min_events=2)).collect()]
        assert got == sorted((k[0], len(g), mean(g)) for k, g in grouped(rows, 10).items() if len(g) >= 2)
    assert reports.delay_by_hour(fact, "", 1).count() == 0  # an empty code is a code like any other


@pytest.mark.parametrize("value", ["NOR' --", "x' union select 1 --", '"NOR"', "NOR\\", "%", "NOR;"])
def test_parameters_are_data(spark, tables, value):
    fact, operators, stops = tables
    assert reports.line_summary(fact, value, min_events=1).count() == 0
    assert reports.worst_stops(fact, stops, value, min_events=1).count() == 0
    assert reports.events_lookup(fact, stops, value, "20260701").count() == 0
    text = "select count(*) from {dim} where operator = :operator"
    assert quality.bound_query(spark, text, {"operator": value}, dim=operators).first()[0] == 0
    assert quality.bound_query(spark, text, {"operator": "NOR"}, dim=operators).first()[0] == 1


def test_lookup_takes_one_day_and_is_ordered(tables):
    fact, _operators, stops = tables
    got = [r.trip_id for r in reports.events_lookup(fact, stops, "EST", "20260630").collect()]
    assert set(got) == {r[4] for r in made_facts() if r[1] == "EST" and r[0] == "20260630"} and got == [
        r.trip_id for r in reports.events_lookup(fact.orderBy(F.rand(1)), stops, "EST", "20260630").collect()
    ]


def test_empty_input(spark, tables):
    nothing = tables[0].where("false")
    row = reliability.service_reliability(nothing).first()
    assert (row.events, row.on_time_pct, row.meets_target) == (0, None, None)
    assert distributions.describe_delay(nothing).first().n == 0
    assert distributions.delay_histogram(nothing).count() == 0
    cv = spark.createDataFrame([], "cv double")
    assert tuple(reliability.travel_time_variability(cv).first()) == (0, None, 0.15, None)


# ------------------------------------------------------------------------------------------ integrity


def test_violations_are_counted(spark, tables):
    fact, operators, stops = tables
    clean = dict(dim_operator=operators, dim_stop=stops, fact_delay_event=fact.withColumn("event_id", F.monotonically_increasing_id()))
    assert {r.violations for r in jobs.star_violations(clean).collect()} == {0}
    quality.require_clean(jobs.star_violations(clean))
    unknown = fact.withColumn("operator", F.when(F.col("trip_id") == "trip-4", "NOPE").otherwise(F.col("operator")))
    holed = unknown.withColumn("delay_min", F.when(F.col("trip_id") != "trip-1", F.col("delay_min")))
    loose = holed.withColumn("stop_id", F.lit(None).cast("string")).withColumn("event_id", F.lit(1))
    faulty = dict(dim_operator=operators.union(operators.limit(1)), dim_stop=stops, fact_delay_event=loose)
    found = {r.check_name: r.violations for r in jobs.star_violations(faulty).collect() if r.violations}
    assert found == {
        "dim_operator.operator": 1,
        "fact_delay_event.event_id": 1,
        "fact_delay_event.operator": 1,  # a NULL stop_id is no violation
        "fact_delay_event.delay_min": 1,
    }
    with pytest.raises(ValueError, match="fact_delay_event.operator=1"):
        quality.require_clean(jobs.star_violations(faulty))


def test_a_code_with_two_names_stays_a_key(spark, tables):
    agency = spark.createDataFrame([("NOR", "B"), ("NOR", "A"), ("XYZ", "C")], "agency_noc string, agency_name string")
    found = {r.operator: r.operator_name for r in star.dim_operator(tables[0], agency).collect()}
    assert found == {"NOR": "A", "SUD": None, "EST": None, "TIE": None}


def test_event_ids_are_dense_and_stable(spark, small):
    events = landing.all_events(spark, small)
    first = star.fact_delay_event(events)
    row = first.agg(F.count("*"), F.min("event_id"), F.max("event_id"), F.count_distinct("event_id")).first()
    assert row[0] == row[2] == row[3] == events.count() and row[1] == 1
    again = star.fact_delay_event(events.repartition(5).orderBy(F.rand(1)))
    assert rows_of(first) == rows_of(again)
    # The number of buckets changes no id.
    assert rows_of(first) == rows_of(star.fact_delay_event(events, digits=1)) == rows_of(star.fact_delay_event(events, digits=3))


# --------------------------------------------------------------------------------------- distributions


def test_descriptive_statistics(spark, small):
    events = landing.all_events(spark, small)
    delays = sorted(r.delay_min for r in events.select("delay_min").collect())
    row = distributions.describe_delay(events).first()
    n, mean, sd = len(delays), statistics.fmean(delays), statistics.stdev(delays)
    pop = statistics.pstdev(delays)
    moment = lambda k: statistics.fmean(((d - mean) / pop) ** k for d in delays)
    expected = dict(
        mean=mean, std=sd, skewness=moment(3), kurtosis=moment(4) - 3, min=delays[0], max=delays[-1],
        median=delays[-(-n // 2) - 1], q1=delays[-(-n // 4) - 1], q3=delays[-(-3 * n // 4) - 1],
    )
    assert row.n == n
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, abs=6e-4), name


def test_histogram_covers_all_values_of_the_range(spark, small):
    events = landing.all_events(spark, small)
    bins = distributions.delay_histogram(events).collect()
    assert sum(r.events for r in bins) == events.where("delay_min between -10 and 40").count()
    assert {r.bin for r in bins} <= set(range(50)) and 49 in {r.bin for r in bins}


def test_density_has_area_one(spark, small):
    points = distributions.delay_density(landing.all_events(spark, small), grid=400, cut=5).collect()
    area = 0.0
    for day in {p.service_date for p in points}:
        line = sorted((p.delay_min, p.density) for p in points if p.service_date == day)
        area += sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(line, line[1:]))
    assert area == pytest.approx(1.0, abs=2e-3)


def test_correlation_leaves_out_unknown_pairs(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    got = {(r.feature_a, r.feature_b): r.corr for r in distributions.feature_correlation(rows, ["a", "b"]).collect()}
    assert got == pytest.approx({("a", "b"): 1.0, ("b", "a"): 1.0, ("a", "a"): 1.0, ("b", "b"): 1.0})


def test_report_dictionaries(spark, small):
    report = jobs.domain_report(landing.all_events(spark, small))
    assert report["service_reliability"].first().events == landing.all_events(spark, small).count()
    assert report["travel_time_variability"].count() == 1
    feed = jobs.feed_report(landing.positions(spark, small), landing.raw_timetable(spark, small))
    assert feed["feed"].first().total_pings == 2 * 4599


def test_layout(spark, small, tmp_path):
    events = landing.all_events(spark, small)
    assert layout.spread_by(events, 16, "operator").rdd.getNumPartitions() == 16
    few = layout.enrich_with_group_counts(events)
    text = layout.plan_text(few)
    assert "BroadcastHashJoin" in text and "== Physical Plan ==" in text
    for mode in ("extended", "formatted"):  # the second one replaces the first
        layout.save_plan(few, f"{tmp_path}/plan.txt", mode)
    assert "(1) Scan parquet" in (tmp_path / "plan.txt").read_text()
    assert [f.name for f in tmp_path.iterdir() if not f.name.startswith(".")] == ["plan.txt"]
    sizes = defaultdict(int)
    for r in events.collect():
        sizes[r.operator] += 1
    assert {(r.operator, r.group_events) for r in few.collect()} == set(sizes.items())


def test_sample_does_not_depend_on_the_partitions(spark, small):
    events = landing.all_events(spark, small)
    key = ["service_date", "trip_id", "vehicle_ref", "origin_aimed_departure", "stop_id"]
    first = layout.sample_by_key(events, 0.25, key, 42)
    again = layout.sample_by_key(events.repartition(7).orderBy(F.rand(2)), 0.25, key, 42)
    assert rows_of(first) == rows_of(again) != rows_of(layout.sample_by_key(events, 0.25, key, 43))
    assert 0.2 < first.count() / events.count() < 0.3


def test_profile_and_headline_repeat_no_row(spark, small):
    from punctual.operators import profiling

    assert "Expand" not in layout.plan_text(profiling.feed_profile(landing.positions(spark, small)), "formatted")
    plan = reports.headline_metrics(landing.all_events(spark, small))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.rindex("partial_sum")  # only above the first aggregate
