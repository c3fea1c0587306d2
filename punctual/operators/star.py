"""The star schema: two dimensions and the fact table."""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.schemas import FACT_COLUMNS


def dim_operator(events: DataFrame, agency: DataFrame) -> DataFrame:
    """Operators seen, with their names where known. A code listed under two names keeps the first in
    alphabetical order, so that the code stays a key."""
    names = agency.groupBy(F.col("agency_noc").alias("operator")).agg(F.min("agency_name").alias("operator_name"))
    return events.select("operator").distinct().join(names, "operator", "left")


def dim_stop(events: DataFrame, stops: DataFrame) -> DataFrame:
    """Stops seen, with name and place where known."""
    return (
        events.select("stop_id").distinct()
        .join(stops.select("stop_id", "stop_name", "stop_lat", "stop_lon"), "stop_id", "left")
    )


def natural_key() -> Column:
    """The text that identifies an event."""
    parts = ["service_date", "trip_id", "vehicle_ref", "origin_aimed_departure", "stop_id"]
    return F.concat_ws("|", *(F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts))


BUCKET_ROWS = 200_000


def fact_delay_event(events: DataFrame, digits: int | None = None) -> DataFrame:
    """The fact with a surrogate key `event_id`: 1, 2, 3, … without gaps, the same in every run.

    The id is the rank of an event by the digest of its natural key. A ranking of all rows would put them
    into one task, so the first `digits` of the digest deal them evenly into buckets; rows are ranked within
    a bucket and moved up by the rows in the buckets before it. How many digits it takes follows from the
    number of rows and changes no id. Only the table of bucket sizes is ordered as a whole.
    """
    if digits is None:
        digits = max(1, ceil(log(max(events.count(), 1) / BUCKET_ROWS, 16)))
    keyed = events.withColumn("_key", natural_key()).withColumn("_digest", F.md5("_key"))
    keyed = keyed.withColumn("_bucket", F.substring("_digest", 1, digits))
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", "_key"))
    return (
        keyed.withColumn("_rank", rank)
        .join(offsets, "_bucket")
        .select((F.col("_offset") + F.col("_rank")).alias("event_id"), *FACT_COLUMNS)
    )
