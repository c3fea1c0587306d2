"""Which services run on a date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The exception codes and weekday columns of the timetable standard.
ADDED, REMOVED = "1", "2"
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def weekday_of(service_date: str) -> str:
    return WEEKDAYS[datetime.strptime(service_date, "%Y%m%d").weekday()]


def active_services(
    calendar: DataFrame, calendar_dates: DataFrame, service_dates: Sequence[str]
) -> DataFrame:
    """Distinct `(service_date, service_id)`: services valid on the weekday, plus those added for the date,
    minus those removed for it.

    All dates go through one plan: a calendar row is expanded to the dates it covers, without a join.
    """
    covered = F.filter(
        F.array(
            *(
                F.struct(F.lit(date).alias("service_date"), F.col(weekday_of(date)).alias("runs"))
                for date in service_dates
            )
        ),
        lambda day: (day["runs"] == "1")
        & (F.col("start_date") <= day["service_date"])
        & (F.col("end_date") >= day["service_date"]),
    )
    regular = calendar.select("service_id", F.explode(covered).alias("day")).select(
        "day.service_date", "service_id"
    )
    changes = calendar_dates.where(F.col("date").isin(*service_dates)).select(
        F.col("date").alias("service_date"), "service_id", "exception_type"
    )
    added = changes.where(F.col("exception_type") == ADDED).drop("exception_type")
    removed = changes.where(F.col("exception_type") == REMOVED).drop("exception_type").distinct()
    return (
        regular.union(added).distinct().join(removed, ["service_date", "service_id"], "left_anti")
    )
