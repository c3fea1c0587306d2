"""SQL that states the feeds and the reconstruction independently of the operators, for DuckDB.

Each oracle is a chain of named sub-queries and one final select over them.
"""

from __future__ import annotations

FEEDS = {
    "fx_agency": """
        select cast(n_nationkey as bigint) agency_id, concat('OP', cast(n_nationkey as varchar)) agency_noc,
               n_name agency_name
        from nation""",
    "fx_routes": """
        select p_partkey route_id, p_partkey % 25 agency_id, cast(p_size % 10 as varchar) route_short_name
        from part""",
    "fx_trips": """
        select o_orderkey trip_id, o_custkey route_id, o_orderpriority service_id,
               cast(o_orderkey % 2 as int) direction_id,
               cast(18000 + ((o_orderkey * 37) % 1200) * 60 as int) origin_sec
        from orders""",
    "fx_stops": """
        select s_suppkey stop_id, s_name stop_name,
               53.3e0 + ((s_suppkey * 7919) % 10000) * 0.00004e0 stop_lat,
               -2.8e0 + ((s_suppkey * 104729) % 10000) * 0.0001e0 stop_lon
        from supplier""",
    "fx_calls": """
        select l_orderkey trip_id, l_linenumber stop_sequence, min(l_suppkey) stop_id, min(l_partkey) pk
        from lineitem group by l_orderkey, l_linenumber""",
    "fx_stop_times": """
        select c.trip_id, c.stop_id, c.pk,
               case when c.trip_id % 13 = 0 and c.stop_sequence = 2 then null else c.stop_sequence end stop_sequence,
               cast(t.origin_sec + 180 * c.stop_sequence as int) sched_sec_raw
        from fx_calls c join fx_trips t on c.trip_id = t.trip_id""",
    "fx_calendar": """
        select * from (values
            ('1-URGENT', '0', '1', '20260101', '20261231'), ('2-HIGH', '1', '1', '20260101', '20261231'),
            ('3-MEDIUM', '1', '1', '20260101', '20261231'), ('4-NOT SPECIFIED', '0', '0', '20260101', '20261231'),
            ('5-LOW', '1', '1', '20250101', '20251231')
        ) as t(service_id, tuesday, wednesday, start_date, end_date)""",
    "fx_calendar_dates": """
        select * from (values
            ('4-NOT SPECIFIED', '20260701', '1'), ('3-MEDIUM', '20260701', '2'), ('5-LOW', '20260702', '1')
        ) as t(service_id, date, exception_type)""",
    "fx_pings": """
        select concat('OP', cast(r.agency_id as varchar)) operator_ref, r.route_short_name line_ref,
               concat('V', cast(t.trip_id % 997 as varchar)) vehicle_ref,
               t.origin_sec + 180 * o.first_seq
                   + (case when t.trip_id % 11 = 0 then 200 else (t.trip_id % 5 - 2) * 40 end) jo,
               st.sched_sec_raw + ((t.trip_id * 48271) % 1801 - 300)
                   + (case when t.trip_id % 4 = 0 then (st.pk * 97) % 3601 - 1800 else (st.pk * 31) % 61 - 30 end)
                   ping_sec,
               s.stop_lat + (st.pk % 21 - 10) * 0.0001e0 latitude,
               s.stop_lon + (st.pk % 13 - 6) * 0.0002e0 longitude
        from fx_stop_times st
        join fx_trips t on st.trip_id = t.trip_id
        join fx_routes r on t.route_id = r.route_id
        join fx_stops s on st.stop_id = s.stop_id
        join (select trip_id, min(stop_sequence) first_seq from fx_calls group by trip_id) o
            on o.trip_id = t.trip_id""",
    # The position feed: every ping under both days.
    "fx_feed": """
        select p.*, d.source_date, strftime(d.midnight + to_seconds(p.ping_sec), '%Y-%m-%dT%H:%M:%S+00:00') recorded_at,
               strftime(d.midnight + to_seconds(p.jo), '%Y-%m-%dT%H:%M:%S+00:00') origin_aimed_departure
        from fx_pings p cross join (values ('20260630', timestamp '2026-06-29 23:00:00'),
            ('20260701', timestamp '2026-06-30 23:00:00')) as d(source_date, midnight)""",
    "gm": """
        select * from fx_stops
        where stop_lat between 53.30e0 and 53.65e0 and stop_lon between -2.75e0 and -1.90e0""",
    # One service per customer and one exception per event: a calendar that grows with the data.
    "fx_services": """
        select o_custkey service_id,
               strftime(date '2023-12-20' + cast(count(*) as int), '%Y%m%d') start_date,
               strftime(date '2023-12-20' + cast(count(*) + cast(sum(o_orderkey) % 40 as bigint) as int), '%Y%m%d') end_date
        from orders group by o_custkey""",
    "fx_exceptions": """
        select user_id service_id, strftime(ts, '%Y%m%d') date,
               case when event_id % 3 = 0 then '2' else '1' end exception_type
        from events""",
}

WEEKDAY = {"20260701": "wednesday", "20260630": "tuesday"}
MIDNIGHT = {"20260701": "2026-06-30 23:00:00", "20260630": "2026-06-29 23:00:00"}


def utc_text(midnight: str, sec: str) -> str:
    return f"strftime(timestamp '{midnight}' + to_seconds({sec}), '%Y-%m-%dT%H:%M:%S+00:00')"


def rounded(value: str, digits: int) -> str:
    scale = f"{10**digits}e0"
    return f"(sign({value}) * floor(abs({value}) * {scale} + 0.5e0) / {scale} + 0e0)"


def grid(value: str, digits: int) -> str:
    """A double as a whole number of its last compared digit."""
    return f"cast(floor(({value}) * 1e{digits} + 0.5e0) as bigint)"


MEAN = "sum(delay_sec) / 60e0 / count(*)"
ON_TIME = "100e0 * sum(case when abs(delay_sec) <= 120 then 1 else 0 end) / count(*)"
N = "count(*)"


def reconstruction(day: str) -> dict[str, str]:
    """The sub-queries of one service day, named with a suffix; the last one is `ev_<day>`."""
    return {
        f"active_{day}": f"""
        select distinct a.service_id from (
            select service_id from fx_calendar
            where {WEEKDAY[day]} = '1' and start_date <= '{day}' and end_date >= '{day}'
            union all
            select service_id from fx_calendar_dates where date = '{day}' and exception_type = '1') a
        where not exists (select 1 from fx_calendar_dates d
            where d.service_id = a.service_id and d.date = '{day}' and d.exception_type = '2')""",
        f"sched_{day}": f"""
        select st.trip_id, st.stop_id, st.stop_sequence, st.sched_sec_raw sched_sec, t.direction_id,
               r.route_short_name line, ag.agency_noc operator, gm.stop_lat, gm.stop_lon
        from fx_stop_times st
        join fx_trips t on st.trip_id = t.trip_id
        join active_{day} a on a.service_id = t.service_id
        join fx_routes r on r.route_id = t.route_id
        left join fx_agency ag on ag.agency_id = r.agency_id
        join gm on gm.stop_id = st.stop_id""",
        f"orig_{day}": f"""
        select * from (select trip_id, operator, line, direction_id, sched_sec origin_sec,
            row_number() over (partition by trip_id order by stop_sequence nulls first) rn from sched_{day}) x
        where rn = 1""",
        f"jr_{day}": """
        select operator_ref operator, line_ref line, jo, count(*) n from fx_pings
        where ping_sec between 0 and 86399 group by 1, 2, 3""",
        f"jt_{day}": f"""
        select * from (select jr.operator, jr.line, jr.jo, jr.n, o.trip_id, o.direction_id,
            row_number() over (partition by jr.operator, jr.line, jr.jo
                               order by abs(jr.jo - o.origin_sec), o.trip_id) rn
            from jr_{day} jr join orig_{day} o on o.operator = jr.operator and o.line = jr.line
            where abs(jr.jo - o.origin_sec) <= 120 and jr.jo between 0 and 86399) x
        where rn = 1""",
        f"cand_{day}": f"""
        select jt.operator, jt.line, s.direction_id, s.trip_id, p.vehicle_ref, jt.jo, s.stop_id, s.stop_sequence,
               s.stop_lat, s.stop_lon, s.sched_sec, p.ping_sec,
               2 * 6371000e0 * asin(sqrt(pow(sin(radians(s.stop_lat - p.latitude) / 2), 2)
                   + cos(radians(p.latitude)) * cos(radians(s.stop_lat))
                   * pow(sin(radians(s.stop_lon - p.longitude) / 2), 2))) dist_m
        from fx_pings p
        join jt_{day} jt on jt.operator = p.operator_ref and jt.line = p.line_ref and jt.jo = p.jo
        join sched_{day} s on s.trip_id = jt.trip_id
        where p.ping_sec between 0 and 86399""",
        f"near_{day}": f"""
        select * from (select *, row_number() over (partition by trip_id, vehicle_ref, jo, stop_id
                                                    order by dist_um, ping_sec, stop_sequence nulls first) rn
            from (select *, cast(floor(dist_m * 1e6 + 0.5e0) as bigint) dist_um from cand_{day} where dist_m <= 120) c) x
        where rn = 1""",
        f"raw_{day}": f"""
        select * from near_{day} where ping_sec - sched_sec between -900 and 5400""",
        f"ks_{day}": f"""
        select trip_id, vehicle_ref, jo, count(*) n_stops, stddev_samp((ping_sec - sched_sec) / 60e0) sd
        from raw_{day} group by trip_id, vehicle_ref, jo""",
        f"ev_{day}": f"""
        select '{day}' service_date, r.operator, r.line, r.direction_id, r.trip_id, r.vehicle_ref,
               {utc_text(MIDNIGHT[day], "r.jo")} origin_aimed_departure, r.stop_id, r.stop_sequence,
               r.stop_lat, r.stop_lon, r.sched_sec, r.ping_sec, r.dist_um,
               r.ping_sec - r.sched_sec delay_sec, (r.ping_sec - r.sched_sec) / 60e0 delay_min
        from raw_{day} r join ks_{day} k
            on r.trip_id = k.trip_id and r.vehicle_ref = k.vehicle_ref and r.jo = k.jo
        where k.n_stops < 3 or k.sd <= 6""",
    }


DAY = "20260701"
STAR = {
    "dim_operator": "select distinct e.operator, a.agency_name operator_name from ev e "
    "left join fx_agency a on a.agency_noc = e.operator",
    "dim_stop": "select distinct e.stop_id, s.stop_name, s.stop_lat, s.stop_lon from ev e "
    "left join fx_stops s on s.stop_id = e.stop_id",
}


def over(final: str, days: tuple[str, ...] = (), **extra: str) -> str:
    """`final` over the feeds, the reconstruction of `days` and any further sub-queries."""
    steps = dict(FEEDS)
    for day in days:
        steps |= reconstruction(day)
    if days:
        steps["ev"] = " union all ".join(f"select * from ev_{day}" for day in days)
        steps |= STAR
    steps |= extra
    chain = ",\n".join(f"{name} as ({text})" for name, text in steps.items())
    return f"with {chain}\n{final}"


def over_day(final: str, **extra: str) -> str:
    return over(final, (DAY,), **extra)


def over_both(final: str, **extra: str) -> str:
    return over(final, ("20260630", DAY), **extra)
