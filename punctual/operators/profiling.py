"""Profiles of the position feed and of how well its keys agree with the timetable."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.measures import round_half_away


# What each number of the profile counts distinct rows of.
PROFILE = {
    "distinct_positions": ["vehicle_ref", "recorded_at", "line_ref", "latitude", "longitude"],
    "distinct_journeys": ["vehicle_ref", "line_ref", "origin_aimed_departure"],
}


def feed_profile(positions: DataFrame) -> DataFrame:
    """One row: volume, and distinct positions, journeys, operators and lines.

    Positions and journeys come from a narrow scan each that combines before its shuffle; the other numbers from a
    third, which counts by operator and line and so moves next to nothing. Several distinct counts in one aggregate
    would first repeat every row for each of them. NULL is a value like any other where several columns are
    counted, and none where one column is.
    """
    rows = F.count(F.lit(1))
    pairs = positions.groupBy("operator_ref", "line_ref").agg(rows.alias("n"))
    small = pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_pings"),
        F.size(F.collect_set("operator_ref")).cast("bigint").alias("distinct_operators"),
        F.size(F.collect_set("line_ref")).cast("bigint").alias("distinct_lines"),
    )
    counts = [positions.select(*columns).distinct().agg(rows.alias(name)) for name, columns in PROFILE.items()]
    return _side_by_side([small, *counts]).select("total_pings", *PROFILE, "distinct_operators", "distinct_lines")


def _side_by_side(single_rows: list[DataFrame]) -> DataFrame:
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), single_rows)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def feed_operators(positions: DataFrame) -> DataFrame:
    return positions.select(F.col("operator_ref").alias("operator")).where("operator is not null").distinct()


def timetable_operators(agency: DataFrame) -> DataFrame:
    return agency.select(F.col("agency_noc").alias("operator")).where("operator is not null").distinct()


def operator_overlap(positions: DataFrame, agency: DataFrame) -> DataFrame:
    """Operators both feeds know."""
    return feed_operators(positions).intersect(timetable_operators(agency))


def unmatched_operators(positions: DataFrame, agency: DataFrame) -> DataFrame:
    """Operators of the position feed that the timetable does not know."""
    return feed_operators(positions).join(timetable_operators(agency), "operator", "left_anti").orderBy("operator")


def join_key_coverage(positions: DataFrame, routes: DataFrame, agency: DataFrame) -> DataFrame:
    """One row: operators on each side and in common, and how many (operator, line) pairs seen on the road
    are in the timetable. All tables are reduced to distinct keys before they meet."""
    codes = (
        feed_operators(positions).withColumn("side", F.lit(1))
        .unionByName(timetable_operators(agency).withColumn("side", F.lit(2)))
        .groupBy("operator").agg(F.sum("side").alias("sides"))
        .agg(
            F.count_if(F.col("sides") != 2).alias("siri_operators"),
            F.count_if(F.col("sides") != 1).alias("gtfs_nocs"),
            F.count_if(F.col("sides") == 3).alias("operator_overlap"),
        )
    )
    seen = positions.select(F.col("operator_ref").alias("operator"), F.col("line_ref").alias("line")).distinct()
    planned = (
        routes.join(agency.select("agency_id", "agency_noc"), "agency_id", "left")
        .select(F.col("agency_noc").alias("operator"), F.col("route_short_name").alias("line"))
        .distinct()
        .withColumn("planned", F.lit(1))
    )
    matched, total = F.count("planned"), F.count(F.lit(1))
    pairs = seen.join(planned, ["operator", "line"], "left").agg(
        total.alias("siri_op_line_pairs"),
        matched.alias("matched_op_line_pairs"),
        F.coalesce(round_half_away(F.lit(100.0) * matched / F.nullif(total, F.lit(0)), 1), F.lit(0.0)).alias(
            "match_rate_pct"
        ),
    )
    return _side_by_side([codes, pairs])
