"""Every registered query with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual import schemas
from punctual.checks import feeds, landing
from punctual.checks.oracle import MEAN, MIDNIGHT, ON_TIME, grid, over, over_both, over_day, rounded, utc_text
from punctual.functions import geo, measures, times
from punctual.models import features, regression
from punctual.models.least_squares import least_squares
from punctual.operators import (
    cleaning,
    clipping,
    distributions,
    layout,
    matching,
    profiling,
    quality,
    reliability,
    reports,
    star,
)
from punctual.operators.calendar import active_services
from punctual.settings import DELAY_MAX_MINUTES, DELAY_MIN_MINUTES, GREATER_MANCHESTER, TEST_DATE, TRAIN_DATE
from punctual.sources import positions as position_source

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DAY = landing.DAY
OPERATOR = "OP3"
# Supports low enough for the smallest checked size to give rows.
FEW_OPERATOR, FEW_LINE, FEW_STOP, FEW_CELL = 100, 20, 2, 30


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def _whole(value, digits: int, name: str):
    """A double as a whole number of its last compared digit: engines differ in the digits beyond."""
    return F.floor(value * float(10**digits) + 0.5).cast("bigint").alias(name)


# ---------------------------------------------------------------------------------- sources and scalars


@query("systematic_sample", "select event_id, user_id, event_type, value from events where event_id % 7 = 0")
def _(spark, sf):
    rows = feeds.read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return position_source.every_nth(rows, 7, "event_id")


@query(
    "siri_explode",
    over(
        """select operator_ref, line_ref, vehicle_ref, recorded_at, origin_aimed_departure, longitude, latitude, source_date
        from fx_feed where latitude between 53.30e0 and 53.65e0 and longitude between -2.75e0 and -1.90e0"""
    ),
)
def _(spark, sf):
    rows = position_source.explode_activities(feeds.as_documents(landing.positions(spark, sf)))
    return rows.select(
        "operator_ref", "line_ref", "vehicle_ref", "recorded_at", "origin_aimed_departure",
        "longitude", "latitude", "source_date",
    )


@query(
    "archive_load",
    over(
        f"""select operator_ref, line_ref, vehicle_ref, recorded_at, origin_aimed_departure, longitude, latitude, source_date
        from fx_feed where latitude between 53.30e0 and 53.65e0 and longitude between -2.75e0 and -1.90e0
            and source_date = '{DAY}'"""
    ),
)
def _(spark, sf):
    rows = position_source.load_positions(spark, {DAY: landing.archives(spark, sf)[DAY]})
    return rows.select(
        "operator_ref", "line_ref", "vehicle_ref", "recorded_at", "origin_aimed_departure",
        "longitude", "latitude", "source_date",
    )


@query("gtfs_time_seconds", over("select trip_id, stop_sequence, sched_sec_raw sched_sec from fx_stop_times"))
def _(spark, sf):
    return landing.raw_timetable(spark, sf).stop_times.select(
        "trip_id", "stop_sequence", times.gtfs_time_seconds(F.col("arrival_time")).alias("sched_sec")
    )


@query(
    "local_seconds",
    over(
        """select operator_ref, line_ref, vehicle_ref, cast(((ping_sec % 86400) + 86400) % 86400 as int) local_sec,
        strftime(d + cast(floor(ping_sec / 86400e0) as int), '%Y%m%d') local_day
        from fx_pings cross join (values (date '2026-06-30'), (date '2026-07-01')) as days(d)"""
    ),
)
def _(spark, sf):
    at = F.col("recorded_at")
    return landing.positions(spark, sf).select(
        "operator_ref", "line_ref", "vehicle_ref",
        times.local_seconds_of_day(at).alias("local_sec"),
        F.date_format(times.local_date(at), "yyyyMMdd").alias("local_day"),
    )


@query(
    "local_date_filter",
    over("select operator_ref, line_ref, vehicle_ref, cast(ping_sec as int) ping_sec from fx_pings "
         "where ping_sec between 0 and 86399"),
)
def _(spark, sf):
    return landing.positions(spark, sf).where(
        (F.col("source_date") == DAY) & times.is_on_service_day(F.col("recorded_at"), F.col("source_date"))
    ).select(
        "operator_ref", "line_ref", "vehicle_ref", times.local_seconds_of_day(F.col("recorded_at")).alias("ping_sec")
    )


_CENTRE = tuple(
    round((a + b) / 2, 6)
    for a, b in (
        (GREATER_MANCHESTER.lat_min, GREATER_MANCHESTER.lat_max), (GREATER_MANCHESTER.lon_min, GREATER_MANCHESTER.lon_max)
    )
)


@query(
    "haversine",
    over(
        f"""select operator_ref, line_ref, count(*) n, cast(sum({grid("d", 3)}) as bigint) total_mm,
        {grid("min(d)", 3)} nearest_mm, {grid("max(d)", 3)} farthest_mm
        from (select *, 2 * 6371000e0 * asin(sqrt(pow(sin(radians({_CENTRE[0]}e0 - latitude) / 2), 2)
            + cos(radians(latitude)) * cos(radians({_CENTRE[0]}e0))
            * pow(sin(radians({_CENTRE[1]}e0 - longitude) / 2), 2))) d from fx_feed) x
        group by operator_ref, line_ref"""
    ),
)
def _(spark, sf):
    d = geo.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(_CENTRE[0]), F.lit(_CENTRE[1]))
    return (
        landing.positions(spark, sf).withColumn("d", d)
        .groupBy("operator_ref", "line_ref")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.floor(F.col("d") * 1000.0 + 0.5)).alias("total_mm"),
            _whole(F.min("d"), 3, "nearest_mm"),
            _whole(F.max("d"), 3, "farthest_mm"),
        )
    )


@query(
    "sched_hour",
    over("select cast((sched_sec_raw // 3600) % 24 as int) sched_hour, count(*) calls from fx_stop_times group by 1"),
)
def _(spark, sf):
    sec = times.gtfs_time_seconds(F.col("arrival_time"))
    return landing.raw_timetable(spark, sf).stop_times.groupBy(times.sched_hour(sec).alias("sched_hour")).agg(
        F.count(F.lit(1)).alias("calls")
    )


# ------------------------------------------------------------------------------------------- timetable


@query("bbox_stops", over("select stop_id, stop_name, stop_lat, stop_lon from gm"))
def _(spark, sf):
    return clipping.clip_stops(landing.raw_timetable(spark, sf).stops)


@query(
    "bbox_pings",
    over(
        """select operator_ref, line_ref, vehicle_ref, latitude, longitude from fx_feed
        where latitude between 53.30e0 and 53.65e0 and longitude between -2.75e0 and -1.90e0"""
    ),
)
def _(spark, sf):
    return (
        landing.positions(spark, sf)
        .where(geo.in_area(F.col("latitude"), F.col("longitude")))
        .select("operator_ref", "line_ref", "vehicle_ref", "latitude", "longitude")
    )


_CLIP = {
    "cst": "select st.* from fx_stop_times st where exists (select 1 from gm where gm.stop_id = st.stop_id)",
    "ct": "select t.* from fx_trips t where exists (select 1 from cst where cst.trip_id = t.trip_id)",
    "cr": "select r.* from fx_routes r where exists (select 1 from ct where ct.route_id = r.route_id)",
}


@query("gtfs_clip_stop_times", over("select trip_id, stop_id, stop_sequence from cst", **_CLIP))
def _(spark, sf):
    return clipping.clip_timetable(landing.raw_timetable(spark, sf)).stop_times.select(
        "trip_id", "stop_id", "stop_sequence"
    )


@query("gtfs_clip_trips", over("select trip_id, route_id, service_id, direction_id from ct", **_CLIP))
def _(spark, sf):
    return clipping.clip_timetable(landing.raw_timetable(spark, sf)).trips.select(
        "trip_id", "route_id", "service_id", "direction_id"
    )


@query("gtfs_clip_routes", over("select route_id, agency_id, route_short_name from cr", **_CLIP))
def _(spark, sf):
    return clipping.clip_timetable(landing.raw_timetable(spark, sf)).routes.select(
        "route_id", "agency_id", "route_short_name"
    )


@query(
    "gtfs_clip_counts",
    over(
        " union all ".join(
            f"select '{table}' table_name, '{stage}' stage, count(*) row_count from {source}"
            for stage, sources in {
                "raw": {"stops": "fx_stops", "routes": "fx_routes", "trips": "fx_trips", "stop_times": "fx_stop_times"},
                "clipped": {"stops": "gm", "routes": "cr", "trips": "ct", "stop_times": "cst"},
            }.items()
            for table, source in sources.items()
        ),
        **_CLIP,
    ),
)
def _(spark, sf):
    raw = landing.raw_timetable(spark, sf)
    return clipping.table_counts({"raw": raw, "clipped": clipping.clip_timetable(raw)})


_DATES = ["20240108", "20240116", "20240124"]


def _active_sql(date: str, weekday: int) -> str:
    return f"""
        select distinct '{date}' service_date, a.service_id from (
            select service_id from fx_services
            where (service_id + {weekday}) % 3 <> 0 and start_date <= '{date}' and end_date >= '{date}'
            union all
            select service_id from fx_exceptions where date = '{date}' and exception_type = '1') a
        where not exists (select 1 from fx_exceptions d
            where d.service_id = a.service_id and d.date = '{date}' and d.exception_type = '2')"""


@query("active_services", over(" union all ".join(_active_sql(d, i) for i, d in enumerate(_DATES))))
def _(spark, sf):
    calendar, exceptions = feeds.customer_calendar(spark, sf)
    return active_services(calendar, exceptions, _DATES)


@query(
    "trip_schedule",
    over_day("select operator, line, direction_id, trip_id, stop_id, stop_sequence, stop_lat, stop_lon, sched_sec "
             f"from sched_{DAY}"),
)
def _(spark, sf):
    return landing.reconstruction(spark, sf).schedule.drop("service_date")


@query("trip_origins", over_day(f"select trip_id, operator, line, direction_id, origin_sec from orig_{DAY}"))
def _(spark, sf):
    return landing.reconstruction(spark, sf).departures.select(
        "trip_id", "operator", "line", "direction_id", "origin_sec"
    )


# -------------------------------------------------------------------------------------------- matching


@query(
    "dedupe_positions",
    over(
        """select distinct operator_ref, line_ref, vehicle_ref, origin_aimed_departure, recorded_at, latitude, longitude
        from fx_feed"""
    ),
)
def _(spark, sf):
    return matching.distinct_positions(feeds.repeated_snapshots(landing.positions(spark, sf)))


@query(
    "distinct_journeys",
    over(
        f"""select operator_ref operator, line_ref line, {utc_text(MIDNIGHT[DAY], "jo")} origin_aimed_departure,
        count(*) n, cast(((jo % 86400) + 86400) % 86400 as int) journey_origin_sec
        from fx_pings where ping_sec between 0 and 86399 group by operator_ref, line_ref, jo"""
    ),
)
def _(spark, sf):
    return matching.observed_journeys(matching.observed_pings(landing.positions(spark, sf), [DAY])).drop("service_date")


@query(
    "pin_journeys",
    over_day(f"select operator, line, {utc_text(MIDNIGHT[DAY], 'jo')} origin_aimed_departure, trip_id, direction_id, n "
             f"from jt_{DAY}"),
)
def _(spark, sf):
    return landing.reconstruction(spark, sf).pinned.drop("service_date", "journey_origin_sec")


_EVENT_SQL = (
    "operator, line, direction_id, trip_id, vehicle_ref, origin_aimed_departure, stop_id, stop_sequence, "
    "stop_lat, stop_lon, sched_sec, cast(ping_sec as int) ping_sec, delay_min, dist_um"
)


def _comparable(events: DataFrame) -> DataFrame:
    return events.withColumn("dist_um", _whole(F.col("dist_m"), 6, "dist_um")).drop("dist_m")


@query(
    "snap_events",
    over_day(
        f"select '{DAY}' service_date, {_EVENT_SQL} from (select *, (ping_sec - sched_sec) / 60e0 delay_min, "
        f"{utc_text(MIDNIGHT[DAY], 'jo')} origin_aimed_departure from raw_{DAY}) x"
    ),
)
def _(spark, sf):
    return _comparable(landing.reconstruction(spark, sf).events)


@query("delay_events", over_day(f"select service_date, {_EVENT_SQL} from ev"))
def _(spark, sf):
    return _comparable(landing.reconstruction(spark, sf).delay_events)


@query("delay_events_multi_day", over_both(f"select service_date, {_EVENT_SQL} from ev"))
def _(spark, sf):
    return _comparable(landing.reconstruction(spark, sf, tuple(feeds.SERVICE_DATES)).delay_events)


@query(
    "journey_coherence",
    over_day(
        f"""select trip_id, vehicle_ref, {utc_text(MIDNIGHT[DAY], "jo")} origin_aimed_departure, n_stops,
        {grid("sd", 6)} std_micro, n_stops < 3 or sd <= 6 coherent from ks_{DAY}"""
    ),
)
def _(spark, sf):
    rows = cleaning.journey_coherence(landing.reconstruction(spark, sf).events)
    return rows.select(
        "trip_id", "vehicle_ref", "origin_aimed_departure", "n_stops",
        _whole(F.col("std_min"), 6, "std_micro"), "coherent",
    )


# A stop that a trip serves twice is one candidate.
_FUNNEL = {
    "pings": "fx_pings where ping_sec between 0 and 86399",
    "candidates": f"""cand_{DAY} c join (select trip_id, stop_id, min(coalesce(stop_sequence, -1)) first_call from sched_{DAY}
        group by trip_id, stop_id) f on f.trip_id = c.trip_id and f.stop_id = c.stop_id
        and f.first_call = coalesce(c.stop_sequence, -1) where c.dist_m <= 120""",
    "nearest": f"near_{DAY}",
    "clamped": f"raw_{DAY}",
    "coherent": "ev",
}


@query(
    "cleaning_funnel",
    over_day(
        " union all ".join(
            f"select {i} step, '{stage}' stage, count(*) row_count from {source}"
            for i, (stage, source) in enumerate(_FUNNEL.items(), 1)
        )
    ),
)
def _(spark, sf):
    run = landing.reconstruction(spark, sf)
    return cleaning.cleaning_funnel(run.pings, run.snapped, run.delay_events, DELAY_MIN_MINUTES, DELAY_MAX_MINUTES)


# ------------------------------------------------------------------------------------------ reliability


@query(
    "service_reliability",
    over_both(f"select count(*) events, {rounded(ON_TIME, 1)} on_time_pct, 85e0 target_pct, "
             f"{rounded(ON_TIME, 1)} >= 85e0 meets_target from ev"),
)
def _(spark, sf):
    return reliability.service_reliability(landing.all_events(spark, sf))


@query(
    "reliability_by_operator",
    over_both(f"select operator, count(*) events, {rounded(ON_TIME, 1)} on_time_pct from ev "
             f"group by operator having count(*) >= {FEW_OPERATOR}"),
)
def _(spark, sf):
    return reliability.reliability_by_operator(landing.all_events(spark, sf), FEW_OPERATOR)


_DURATIONS = {
    "durations": """select service_date, trip_id, vehicle_ref, origin_aimed_departure, operator, line, direction_id,
        cast(max(ping_sec) - min(ping_sec) as int) obs_duration_s, count(*) n_stops from ev
        group by all having count(*) >= 3 and max(ping_sec) - min(ping_sec) > 0""",
    "routes_cv": """select line, direction_id, count(*) n_trips, avg(obs_duration_s) mean_dur,
        stddev_samp(obs_duration_s) sd_dur, stddev_samp(obs_duration_s) / avg(obs_duration_s) cv
        from durations group by line, direction_id having count(*) >= 20""",
}


@query("journey_durations", over_both("select * from durations", **_DURATIONS))
def _(spark, sf):
    return reliability.journey_durations(landing.all_events(spark, sf))


@query(
    "route_cv",
    over_both(f"select line, direction_id, n_trips, {grid('mean_dur', 4)} mean_dur_e4, {grid('sd_dur', 4)} sd_dur_e4, "
             f"{grid('cv', 8)} cv_e8 from routes_cv", **_DURATIONS),
)
def _(spark, sf):
    routes = reliability.route_cv(reliability.journey_durations(landing.all_events(spark, sf)))
    return routes.select(
        "line", "direction_id", "n_trips", _whole(F.col("mean_dur"), 4, "mean_dur_e4"),
        _whole(F.col("sd_dur"), 4, "sd_dur_e4"), _whole(F.col("cv"), 8, "cv_e8"),
    )


@query(
    "ttv_summary",
    over_both(
        f"""select count(*) routes_assessed, {rounded("quantile_disc(cv, 0.5)", 3)} median_cv, 0.15e0 target_cv,
        {rounded("100e0 * sum(case when cv <= 0.15e0 then 1 else 0 end) / count(*)", 1)} pct_routes_meeting_target
        from routes_cv""",
        **_DURATIONS,
    ),
)
def _(spark, sf):
    durations = reliability.journey_durations(landing.all_events(spark, sf))
    return reliability.travel_time_variability(reliability.route_cv(durations))


# ----------------------------------------------------------------------------------------- star schema


def _star(spark, sf):
    events = landing.all_events(spark, sf)
    feed = landing.timetable(spark, sf)
    return events, star.dim_operator(events, feed.agency), star.dim_stop(events, feed.stops)


@query("dim_operator", over_both("select * from dim_operator"))
def _(spark, sf):
    return _star(spark, sf)[1]


@query("dim_stop", over_both("select * from dim_stop"))
def _(spark, sf):
    return _star(spark, sf)[2]


@query(
    "fact_delay_event",
    over_both(
        """select row_number() over (order by md5(k), k) event_id, service_date, operator, line,
        direction_id, trip_id, stop_id, stop_sequence, sched_sec, cast(ping_sec as int) ping_sec, delay_min
        from (select *, concat_ws('|', service_date, cast(trip_id as varchar), vehicle_ref, origin_aimed_departure,
            cast(stop_id as varchar)) k from ev) x"""
    ),
)
def _(spark, sf):
    return star.fact_delay_event(landing.all_events(spark, sf))


@query(
    "headline_metrics",
    over_both(
        f"""select count(*) events, {rounded(MEAN, 2)} mean_delay, {rounded(ON_TIME, 1)} on_time_pct,
        count(distinct operator) operators, count(distinct line) lines,
        {rounded(f"({rounded(ON_TIME, 1)} - 85e0)", 1)} gap_to_target from ev"""
    ),
)
def _(spark, sf):
    return reports.headline_metrics(landing.all_events(spark, sf))


@query(
    "operator_summary",
    over_both(
        f"""select e.operator, o.operator_name, count(*) events, {rounded(MEAN, 2)} mean_delay,
        {rounded(ON_TIME, 1)} on_time_pct from ev e join dim_operator o on o.operator = e.operator
        group by e.operator, o.operator_name having count(*) >= {FEW_OPERATOR}"""
    ),
)
def _(spark, sf):
    fact, operators, _stops = _star(spark, sf)
    return reports.operator_summary(fact, operators, FEW_OPERATOR)


@query(
    "operator_mean_named",
    over_both(
        f"""select e.operator, o.operator_name, count(*) events, {rounded(MEAN, 2)} mean_delay
        from ev e join dim_operator o on o.operator = e.operator group by e.operator, o.operator_name"""
    ),
)
def _(spark, sf):
    fact, operators, _stops = _star(spark, sf)
    return reports.operator_mean_named(fact, operators)


_LINES = f"""select line, count(*) events, {rounded(MEAN, 2)} mean_delay, {rounded(ON_TIME, 1)} on_time_pct
    from ev where operator = '{OPERATOR}' group by line having count(*) >= {FEW_LINE}"""


@query("line_summary", over_both(_LINES))
def _(spark, sf):
    return reports.line_summary(landing.all_events(spark, sf), OPERATOR, FEW_LINE)


@query("line_summary_top", over_both(f"{_LINES} order by mean_delay desc, line limit 4"))
def _(spark, sf):
    return reports.line_summary(landing.all_events(spark, sf), OPERATOR, FEW_LINE, limit=4)


_HOURS = f"select cast((sched_sec // 3600) % 24 as int) sched_hour, count(*) events, {rounded(MEAN, 2)} mean_delay from ev"


@query("delay_by_hour", over_both(f"{_HOURS} group by 1 having count(*) >= 200"))
def _(spark, sf):
    return reports.delay_by_hour(landing.all_events(spark, sf))


@query("delay_by_hour_operator", over_both(f"{_HOURS} where operator = '{OPERATOR}' group by 1 having count(*) >= 10"))
def _(spark, sf):
    return reports.delay_by_hour(landing.all_events(spark, sf), OPERATOR, min_events=10)


@query(
    "worst_stops",
    over_both(
        f"""select s.stop_name, e.stop_sequence, count(*) events, {rounded(MEAN, 2)} mean_delay
        from ev e join dim_stop s on s.stop_id = e.stop_id where e.operator = '{OPERATOR}'
        group by s.stop_name, e.stop_sequence having count(*) >= {FEW_STOP}
        order by mean_delay desc, s.stop_name, e.stop_sequence limit 15"""
    ),
)
def _(spark, sf):
    fact, _operators, stops = _star(spark, sf)
    return reports.worst_stops(fact, stops, OPERATOR, min_events=FEW_STOP)


@query(
    "least_reliable_lines",
    over_both(
        f"""select operator, line, count(*) events, {rounded(MEAN, 2)} mean_delay, {rounded(ON_TIME, 1)} on_time_pct
        from ev group by operator, line having count(*) >= {FEW_LINE}
        order by mean_delay desc, operator, line limit 20"""
    ),
)
def _(spark, sf):
    return reports.least_reliable_lines(landing.all_events(spark, sf), FEW_LINE)


@query(
    "delay_by_operator_top",
    over_both(f"select operator, {MEAN} mean_delay, count(*) events from ev group by operator "
             f"having count(*) >= {FEW_OPERATOR} order by mean_delay desc, operator limit 15"),
)
def _(spark, sf):
    return reports.delay_by_operator(landing.all_events(spark, sf), FEW_OPERATOR)


_LOOKUP = """select e.line, e.trip_id, s.stop_name, e.stop_sequence, e.delay_min
    from ev e join dim_stop s on s.stop_id = e.stop_id where e.operator = '{0}' and e.service_date = '{1}'"""


@query("events_lookup", over_both(_LOOKUP.format(OPERATOR, DAY)))
def _(spark, sf):
    fact, _operators, stops = _star(spark, sf)
    return reports.events_lookup(fact, stops, OPERATOR, DAY)


# ---------------------------------------------------------------------------------------- distributions


@query(
    "delay_run_summary",
    over_both(
        f"""select count(*) events, {rounded(MEAN, 2)} mean_delay_min,
        {rounded("quantile_disc(delay_sec, 0.5) / 60e0", 2)} median_delay_min,
        {rounded("stddev_samp(delay_min)", 2)} std_delay_min, {rounded("min(delay_min)", 2)} min_delay_min,
        {rounded("max(delay_min)", 2)} max_delay_min,
        count(*) filter (where delay_min >= -1e0 and delay_min <= 5.99e0) on_time,
        {rounded("100e0 * count(*) filter (where delay_min >= -1e0 and delay_min <= 5.99e0) / count(*)", 1)} on_time_pct,
        count(*) filter (where delay_min > 20e0) tail,
        {rounded("100e0 * count(*) filter (where delay_min > 20e0) / count(*)", 1)} tail_pct from ev"""
    ),
)
def _(spark, sf):
    return distributions.delay_run_summary(landing.all_events(spark, sf))


@query(
    "describe_delay",
    over_both(
        f"""select n, {rounded("mean", 3)} mean, {rounded("median", 3)} median, {rounded("std", 3)} std,
        {rounded("m3 / pow(m2, 1.5e0)", 3)} skewness, {rounded("m4 / (m2 * m2) - 3e0", 3)} kurtosis,
        {rounded("q1", 3)} q1, {rounded("q3", 3)} q3, {rounded("lo", 3)} min, {rounded("hi", 3)} max
        from (select count(*) n, {MEAN} mean, quantile_disc(delay_sec, 0.5) / 60e0 median,
            quantile_disc(delay_sec, 0.25) / 60e0 q1, quantile_disc(delay_sec, 0.75) / 60e0 q3,
            stddev_samp(delay_min) std, min(delay_min) lo, max(delay_min) hi,
            avg(pow(delay_min - m, 2)) m2, avg(pow(delay_min - m, 3)) m3, avg(pow(delay_min - m, 4)) m4
            from ev, (select avg(delay_min) m from ev) centre) x"""
    ),
)
def _(spark, sf):
    return distributions.describe_delay(landing.all_events(spark, sf))


@query(
    "delay_by_stop_sequence",
    over_both(f"select stop_sequence, {MEAN} mean_delay, count(*) events from ev where stop_sequence <= 40 "
             "group by stop_sequence having count(*) >= 200"),
)
def _(spark, sf):
    return reports.delay_by_stop_sequence(landing.all_events(spark, sf))


@query(
    "delay_by_cell",
    over_both(
        f"""select {rounded("stop_lat", 2)} lat, {rounded("stop_lon", 2)} lon, {MEAN} mean_delay, count(*) events
        from ev group by 1, 2 having count(*) >= {FEW_CELL}"""
    ),
)
def _(spark, sf):
    return reports.delay_by_cell(landing.all_events(spark, sf), min_events=FEW_CELL)


@query(
    "delay_histogram",
    over_both(
        """select cast(bin as int) bin, (lo + bin * width / 50e0) / 60e0 bin_start_min, count(*) events
        from (select least(floor((delay_sec - lo) * 50 / cast(width as double)), 49) bin, lo, width
            from (select delay_sec, min(delay_sec) over () lo, greatest(max(delay_sec) over () - min(delay_sec) over (), 1) width
                from ev where delay_min between -10e0 and 40e0) x) y group by bin, lo, width"""
    ),
)
def _(spark, sf):
    return distributions.delay_histogram(landing.all_events(spark, sf))


@query(
    "delay_density_by_day",
    over_both(
        f"""select service_date, cast(point as int) point, {grid("delay_min", 6)} delay_micro, {grid("density", 9)} density_e9
        from (select p.service_date, p.point, p.delay_min,
                sum(exp(-0.5e0 * pow((p.delay_min - c.x) / p.bw, 2)) / (sqrt(2 * pi()) * p.bw * p.norm)) density
            from (select *, lo - 3 * bw + point * ((hi + 3 * bw) - (lo - 3 * bw)) / 199e0 delay_min
                from (select service_date, stddev_samp(delay_min) * pow(count(*), -0.2e0) bw,
                        sum(count(*)) over () norm, min(delay_min) lo, max(delay_min) hi
                    from ev where delay_min between -10e0 and 30e0 group by service_date) shape,
                    (select unnest(range(200)) point) pts) p
            join (select service_date, delay_sec / 60e0 x from ev where delay_min between -10e0 and 30e0) c
                on c.service_date = p.service_date
            group by p.service_date, p.point, p.delay_min) d"""
    ),
)
def _(spark, sf):
    rows = distributions.delay_density(landing.all_events(spark, sf))
    return rows.select(
        "service_date", "point", _whole(F.col("delay_min"), 6, "delay_micro"), _whole(F.col("density"), 9, "density_e9")
    )


_PAIRS = [(a, b) for i, a in enumerate(distributions.FEATURES) for b in distributions.FEATURES[i + 1 :]]


@query(
    "feature_correlation",
    over_both(
        "select feature_a, feature_b, " + grid("corr", 8) + " corr_e8 from ("
        + " union all ".join(
            f"select '{x}' feature_a, '{y}' feature_b, corr({a}, {b}) corr from e"
            for a, b in _PAIRS
            for x, y in ((a, b), (b, a))
        )
        + "".join(f" union all select '{c}', '{c}', 1e0" for c in distributions.FEATURES)
        + ") x",
        e="select *, (sched_sec // 3600) % 24 sched_hour from ev",
    ),
)
def _(spark, sf):
    rows = distributions.feature_correlation(features.add_derived_features(landing.all_events(spark, sf)))
    return rows.select("feature_a", "feature_b", _whole(F.col("corr"), 8, "corr_e8"))


@query(
    "group_count_enrich",
    over_both(
        """select e.operator, e.trip_id, e.stop_id, e.delay_min, c.group_events from ev e
        join (select operator, count(*) group_events from ev group by operator) c on c.operator = e.operator"""
    ),
)
def _(spark, sf):
    return layout.enrich_with_group_counts(landing.all_events(spark, sf)).select(
        "operator", "trip_id", "stop_id", "delay_min", "group_events"
    )


@query(
    "bernoulli_sample",
    over_both(
        """select service_date, trip_id, vehicle_ref, origin_aimed_departure, stop_id, delay_min
        from (select *, concat_ws('|', '42', service_date, cast(trip_id as varchar), vehicle_ref, origin_aimed_departure,
            cast(stop_id as varchar)) k from ev) x where cast('0x' || substring(md5(k), 1, 8) as bigint) < 0.25e0 * 4294967296"""
    ),
)
def _(spark, sf):
    key = ["service_date", "trip_id", "vehicle_ref", "origin_aimed_departure", "stop_id"]
    return layout.sample_by_key(landing.all_events(spark, sf), 0.25, key, 42).select(*key, "delay_min")


# ------------------------------------------------------------------------------------------ feed profile


@query(
    "feed_profile",
    over(
        """select 2 * count(*) total_pings,
        count(distinct (vehicle_ref, recorded_at, line_ref, latitude, longitude)) distinct_positions,
        count(distinct (vehicle_ref, line_ref, origin_aimed_departure)) distinct_journeys,
        count(distinct operator_ref) distinct_operators, count(distinct line_ref) distinct_lines from fx_feed"""
    ),
)
def _(spark, sf):
    return profiling.feed_profile(feeds.repeated_snapshots(landing.positions(spark, sf)))


# Vehicles of lines 7 to 9 report an operator, and those of V1 a line, that the timetable does not know.
_KEYS = {
    "planned": "select distinct a.agency_noc, r.route_short_name from fx_routes r left join fx_agency a on a.agency_id = r.agency_id",
    "seen": """select distinct case when line_ref >= '7' then 'NOWHERE' else operator_ref end operator_ref,
        case when vehicle_ref = 'V1' then 'X99' else line_ref end line_ref from fx_feed""",
}


def _key_inputs(spark, sf):
    feed = landing.raw_timetable(spark, sf)
    unknown = landing.positions(spark, sf).withColumns(
        {
            "operator_ref": F.when(F.col("line_ref") >= "7", "NOWHERE").otherwise(F.col("operator_ref")),
            "line_ref": F.when(F.col("vehicle_ref") == "V1", "X99").otherwise(F.col("line_ref")),
        }
    )
    return unknown, feed.routes, feed.agency


@query(
    "join_key_coverage",
    over(
        f"""select (select count(distinct operator_ref) from seen) siri_operators,
        (select count(distinct agency_noc) from fx_agency) gtfs_nocs,
        (select count(distinct agency_noc) from fx_agency where agency_noc in (select operator_ref from seen)) operator_overlap,
        count(*) siri_op_line_pairs, count(p.agency_noc) matched_op_line_pairs,
        {rounded("100e0 * count(p.agency_noc) / count(*)", 1)} match_rate_pct
        from seen s left join planned p on p.agency_noc = s.operator_ref and p.route_short_name = s.line_ref""",
        **_KEYS,
    ),
)
def _(spark, sf):
    return profiling.join_key_coverage(*_key_inputs(spark, sf))


@query(
    "operator_overlap",
    over("select operator_ref as operator from seen intersect select agency_noc from fx_agency", **_KEYS),
)
def _(spark, sf):
    pings, _routes, agency = _key_inputs(spark, sf)
    return profiling.operator_overlap(pings, agency)


@query(
    "unmatched_operators",
    over("select operator_ref as operator from seen except select agency_noc from fx_agency", **_KEYS),
)
def _(spark, sf):
    pings, _routes, agency = _key_inputs(spark, sf)
    return profiling.unmatched_operators(pings, agency)


# ----------------------------------------------------------------------------------------------- models


@query(
    "time_split",
    over_both("select case when service_date = '20260630' then 'train' else 'test' end part, operator, count(*) events, "
              "cast(sum(delay_sec) as bigint) delay_sec from ev group by 1, 2"),
)
def _(spark, sf):
    train, test = features.time_split(landing.all_events(spark, sf))
    parts = train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part", "operator").agg(
        F.count(F.lit(1)).alias("events"), F.sum(measures.delay_seconds(F.col("delay_min"))).alias("delay_sec")
    )


def _baseline_sql(by: str = "") -> str:
    group = f"{by} as model, " if by else ""
    return f"""select {group}sqrt(avg(pow(delay_min - m, 2))) rmse, avg(abs(delay_min - m)) mae,
        1e0 - avg(pow(delay_min - m, 2)) / var_pop(delay_min) r2, max(ping_sec) - min(ping_sec) span_s
        from ev, (select {MEAN} m from ev where service_date = '20260630') base
        where service_date = '20260701' {f"group by {by}" if by else ""}"""


def _baseline(spark, sf, by: tuple[str, ...] = ()):
    train, test = features.time_split(landing.all_events(spark, sf))
    predicted = regression.predict_mean(train, test)
    return predicted, regression.regression_metrics(predicted, by)


@query(
    "baseline_mean_metrics",
    over_both(f"select {grid('rmse', 6)} rmse_micro, {grid('mae', 6)} mae_micro, {grid('r2', 6)} r2_micro from b",
              b=_baseline_sql()),
)
def _(spark, sf):
    _predicted, scores = _baseline(spark, sf)
    return scores.select(*(_whole(F.col(c), 6, f"{c}_micro") for c in ("rmse", "mae", "r2")))


@query(
    "model_metrics_long",
    over_both(
        f"""select model, 'RMSE' metric, {grid("rmse", 6)} minutes_micro from b
        union all select model, 'MAE', {grid("mae", 6)} from b""",
        b=_baseline_sql("operator"),
    ),
)
def _(spark, sf):
    """The baseline judged on each operator alone takes the place of the models."""
    _predicted, scores = _baseline(spark, sf, ("operator",))
    long = regression.metrics_long(scores.withColumnRenamed("operator", "model"))
    return long.select("model", "metric", _whole(F.col("minutes"), 6, "minutes_micro"))


@query(
    "model_efficiency",
    over_both(f"select model, {grid('1e0 / (rmse * span_s)', 12)} efficiency_e12 from b where span_s > 0",
              b=_baseline_sql("operator")),
)
def _(spark, sf):
    """The time span of each operator's pings takes the place of training seconds."""
    predicted, scores = _baseline(spark, sf, ("operator",))
    spans = predicted.groupBy("operator").agg((F.max("ping_sec") - F.min("ping_sec")).alias("span_s"))
    value = measures.model_efficiency(F.col("rmse"), F.col("span_s"))
    return scores.join(spans, "operator").where("span_s > 0").select(
        F.col("operator").alias("model"), _whole(value, 12, "efficiency_e12")
    )


@query(
    "linear_model_metrics",
    over_both(
        f"""select 'operator + stop_sequence' model, {grid("sqrt(avg(e * e))", 6)} rmse_micro, {grid("avg(abs(e))", 6)} mae_micro,
            {grid("1e0 - avg(e * e) / var_pop(delay_min)", 6)} r2_micro
        from (select delay_min, delay_min - m.y - (select slope from s) * (coalesce(cast(t.stop_sequence as double), 0e0) - m.x) e
              from ev t join m on t.operator = m.operator where service_date = '{TEST_DATE}') z""",
        tr=f"select operator, coalesce(cast(stop_sequence as double), 0e0) x, delay_min y from ev where service_date = '{TRAIN_DATE}'",
        m="select operator, avg(x) x, avg(y) y from tr group by operator",
        s="select sum((tr.x - m.x) * (tr.y - m.y)) / sum((tr.x - m.x) * (tr.x - m.x)) slope from tr join m on tr.operator = m.operator",
    ),
)
def _(spark, sf):
    """Operators as categories beside one number: what a line within each operator fits best is known in closed form."""
    train, test = features.time_split(features.add_derived_features(landing.all_events(spark, sf)))
    model, _errors = least_squares(regression.with_fold(train), features.TARGET, ["operator"], ["stop_sequence"], fold="fold")
    known = test.join(train.select("operator").distinct(), "operator", "left_semi").withColumn("prediction", model.prediction())
    scores = regression.regression_metrics(known)
    return scores.select(
        F.lit("operator + stop_sequence").alias("model"),
        *(_whole(F.col(c), 6, f"{c}_micro") for c in ("rmse", "mae", "r2")),
    )


@query("feature_vectors")
def _(spark, sf):
    train, test = features.time_split(features.add_derived_features(landing.all_events(spark, sf)))
    fitted = features.feature_pipeline().fit(train)
    return fitted.transform(test).select(
        "service_date", "operator", "line", "trip_id", "stop_id", vector_to_array("features").alias("features")
    )


@query("model_comparison")
def _(spark, sf):
    return regression.compare_models(landing.all_events(spark, sf))


# ---------------------------------------------------------------------------------------------- quality


def _faulty_star(spark, sf):
    """The star schema with faults planted: stops listed twice, a missing operator, missing delays."""
    fact, operators, stops = _star(spark, sf)
    twice = stops.union(stops.where(F.col("stop_id") % 3 == 0))
    fewer = operators.where(F.col("operator") != OPERATOR)
    holed = fact.withColumn("delay_min", F.when(F.col("trip_id") % 10 != 0, F.col("delay_min")))
    return holed, fewer, twice


@query(
    "pk_violations",
    over_both(
        """select 'dim_operator.operator' check_name, cast(0 as bigint) violations
        union all select 'dim_stop.stop_id', count(*) from dim_stop where stop_id % 3 = 0
        union all select 'delay_events', count(*) - count(distinct (service_date, trip_id, vehicle_ref,
            origin_aimed_departure, stop_id)) from ev"""
    ),
)
def _(spark, sf):
    fact, operators, stops = _faulty_star(spark, sf)
    key = ["service_date", "trip_id", "vehicle_ref", "origin_aimed_departure", "stop_id"]
    return quality.pk_violations(
        {
            "dim_operator.operator": (operators, ["operator"]),
            "dim_stop.stop_id": (stops, ["stop_id"]),
            "delay_events": (fact, key),
        }
    )


@query(
    "fk_violations",
    over_both(
        f"""select 'fact.operator' check_name, count(*) violations from ev where operator = '{OPERATOR}'
        union all select 'fact.stop_id', cast(0 as bigint)"""
    ),
)
def _(spark, sf):
    fact, operators, stops = _faulty_star(spark, sf)
    return quality.fk_violations(
        {
            "fact.operator": (fact, "operator", operators, "operator"),
            "fact.stop_id": (fact, "stop_id", stops, "stop_id"),
        }
    )


@query(
    "null_violations",
    over_both(
        """select 'fact.service_date' check_name, cast(0 as bigint) violations
        union all select 'fact.operator', cast(0 as bigint)
        union all select 'fact.delay_min', count(*) from ev where trip_id % 10 = 0
        union all select 'positions.recorded_at', cast(0 as bigint)
        union all select 'positions.source_date', cast(0 as bigint)"""
        + "".join(
            f" union all select '{table}.{column}', count(*) filter (where {column} is null) from {source}"
            for table, source in {
                "stops": "fx_stops", "routes": "fx_routes", "trips": "fx_trips", "stop_times": "fx_stop_times",
                "calendar": "fx_calendar", "calendar_dates": "fx_calendar_dates", "agency": "fx_agency",
            }.items()
            for column in schemas.REQUIRED[table]
        )
    ),
)
def _(spark, sf):
    fact, _operators, _stops = _faulty_star(spark, sf)
    feed = landing.raw_timetable(spark, sf)
    return quality.null_violations(
        {
            "fact": (fact, ["service_date", "operator", "delay_min"]),
            "positions": (landing.positions(spark, sf), ["recorded_at", "source_date"]),
            **{name: (getattr(feed, name), columns) for name, columns in schemas.REQUIRED.items() if name != "positions"},
        }
    )


_PAYLOADS = {
    "plain": OPERATOR,
    "comment": f"{OPERATOR}' /* whatever follows",
    "union": "none' union all select operator, 1 from fact where 'a' = 'a",
    "typographic": f"{OPERATOR}\u2019 or true",
    "stacked": f"{OPERATOR}'); truncate table fact; select ('",
    "empty": "",
}


@query(
    "injection_lookup",
    over_both(
        f"select 'plain' payload, count(*) events from ev where operator = '{OPERATOR}'"
        + "".join(f" union all select '{p}', cast(0 as bigint)" for p in _PAYLOADS if p != "plain")
    ),
)
def _(spark, sf):
    fact = landing.all_events(spark, sf)
    rows = None
    for name, value in _PAYLOADS.items():
        one = quality.bound_query(
            spark,
            "select :name as payload, count(*) as events from {fact} where operator = :operator",
            {"name": name, "operator": value},
            fact=fact,
        )
        rows = one if rows is None else rows.union(one)
    return rows
