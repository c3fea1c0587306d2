"""Times of day, service dates and zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctual.settings import LOCAL_ZONE

DAY_SEC = 86_400


def gtfs_time_seconds(text: Column) -> Column:
    """'HH:MM:SS', where HH may pass 24, as seconds after midnight. NULL if it cannot be read."""
    parts = F.split(text, ":")
    hours, minutes, seconds = (F.get(parts, F.lit(i)).try_cast("int") for i in range(3))
    return hours * 3600 + minutes * 60 + seconds


def local_clock(utc_text: Column, zone: str) -> Column:
    """Seconds since 1970 of the *local wall clock* at a UTC instant given as ISO text.

    Working on this number instead of `hour()`/`to_date()` makes the results below independent of the
    time zone of the session.
    """
    return F.unix_seconds(F.from_utc_timestamp(F.try_to_timestamp(utc_text), zone))


def local_seconds(clock: Column) -> Column:
    """The second of the day of a `local_clock`."""
    return F.pmod(clock, F.lit(DAY_SEC)).cast("int")


def local_day(clock: Column) -> Column:
    """The day of a `local_clock`, counted from 1970."""
    return F.floor(clock / DAY_SEC).cast("int")


def local_seconds_of_day(utc_text: Column, zone: str = LOCAL_ZONE) -> Column:
    return local_seconds(local_clock(utc_text, zone))


def local_date(utc_text: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.date_from_unix_date(local_day(local_clock(utc_text, zone)))


def service_day(text: Column) -> Column:
    """'YYYYMMDD' as a date, NULL if it cannot be read."""
    parts = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(F.length(text) == 8, parts.try_cast("date"))


def is_on_service_day(utc_text: Column, service_date: Column, zone: str = LOCAL_ZONE) -> Column:
    return local_date(utc_text, zone) == service_day(service_date)


def sched_hour(sched_sec: Column) -> Column:
    """Hour of the clock (0..23) of a scheduled second; seconds past midnight wrap around."""
    return (sched_sec / 3600).cast("int") % 24
