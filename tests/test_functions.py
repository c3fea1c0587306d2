import math

import pytest
from pyspark.sql import functions as F

from punctual.functions import geo, measures, times
from punctual.settings import GREATER_MANCHESTER as GM


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("00:00:00", 0), ("08:05:09", 29109), ("8:05:09", 29109), ("25:10:00", 90600),
        ("xx:00:00", None), ("08:00", None), ("", None), (None, None),
    ],
)
def test_time_of_day(spark, text, seconds):
    assert one(spark, times.gtfs_time_seconds(F.lit(text).cast("string"))) == seconds


@pytest.mark.parametrize("session_zone", ["UTC", "Europe/London", "Asia/Kathmandu"])
def test_local_time_does_not_depend_on_the_session(spark, zone, session_zone):
    zone(session_zone)
    cases = {
        "2026-07-01T09:00:00+00:00": (10 * 3600, "2026-07-01"),  # summer
        "2026-01-15T09:00:00+00:00": (9 * 3600, "2026-01-15"),  # winter
        "2026-06-30T23:30:00Z": (1800, "2026-07-01"),  # already the next day
        "not a time": (None, None),
    }
    for text, (sec, day) in cases.items():
        got = one(spark, F.struct(
            times.local_seconds_of_day(F.lit(text)).alias("s"), times.local_date(F.lit(text)).cast("string").alias("d")
        ))
        assert (got.s, got.d) == (sec, day)


def test_service_day_filter(spark):
    on = times.is_on_service_day(F.lit("2026-06-30T23:30:00+00:00"), F.lit("20260701"))
    off = times.is_on_service_day(F.lit("2026-06-30T22:59:59+00:00"), F.lit("20260701"))
    assert (one(spark, on), one(spark, off)) == (True, False)
    assert one(spark, times.service_day(F.lit("2026071"))) is None


def test_sched_hour_wraps(spark):
    got = [one(spark, times.sched_hour(F.lit(s))) for s in (0, 3599, 3600, 86399, 86400, 90000)]
    assert got == [0, 0, 1, 23, 0, 1]


@pytest.mark.parametrize("up", [-0.1, 0.0, 0.5, 1.0, 1.1])
@pytest.mark.parametrize("along", [-0.1, 0.0, 0.5, 1.0, 1.1])
def test_area(spark, up, along):
    """Points at shares of the box's height and width; its edges belong to it."""
    lat = GM.lat_max if up == 1.0 else GM.lat_min + up * (GM.lat_max - GM.lat_min)
    lon = GM.lon_max if along == 1.0 else GM.lon_min + along * (GM.lon_max - GM.lon_min)
    assert one(spark, geo.in_area(F.lit(lat), F.lit(lon))) is (0 <= up <= 1 and 0 <= along <= 1)


def test_haversine(spark):
    degree = one(spark, geo.haversine_m(F.lit(53.0), F.lit(-2.0), F.lit(54.0), F.lit(-2.0)))
    assert degree == pytest.approx(math.radians(1) * 6_371_000, rel=1e-12)
    antipodes = one(spark, geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))
    assert antipodes == pytest.approx(math.pi * 6_371_000)
    assert one(spark, geo.haversine_m(F.lit(53.0), F.lit(-2.0), F.lit(53.0), F.lit(-2.0))) == 0.0


@pytest.mark.parametrize(
    "value, digits, rounded", [(0.125, 2, 0.13), (-0.125, 2, -0.13), (2.5, 0, 3.0), (66.66666, 1, 66.7), (-0.001, 2, 0.0)]
)
def test_rounding(spark, value, digits, rounded):
    got = one(spark, measures.round_half_away(F.lit(value), digits))
    assert got == rounded and math.copysign(1, got) == math.copysign(1, rounded)


def test_model_efficiency(spark):
    assert one(spark, measures.model_efficiency(F.lit(4.0), F.lit(0.5))) == 0.5
    assert math.isnan(one(spark, measures.model_efficiency(F.lit(4.0), F.lit(0.0))))


def test_on_time_share_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "delay_min double")
    assert empty.agg(measures.on_time_pct(F.col("delay_min"))).first()[0] is None
