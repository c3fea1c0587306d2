"""Exact quantiles of any number of values, without sorting them in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 4096


def quantile_disc(rows: DataFrame, column: str, q: float, ranges: int = RANGES) -> DataFrame:
    """One row, `value`: the smallest value that at least a share `q` of the values does not exceed.

    Values are counted by ranges of equal width; the counts say in which range the wanted rank is, and only the
    distinct values of that range are put in order. NULL is no value; NULL comes back where there is none.
    """
    known = rows.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    low, high = known.agg(F.min("v")).scalar(), known.agg(F.max("v")).scalar()
    # every step keeps the order of values, rounding included
    place = F.least(F.floor((F.col("v") - low) / (high - low) * ranges), F.lit(ranges - 1))
    placed = known.withColumn("place", F.when(high > low, place).otherwise(F.lit(0)))
    counted = placed.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    # at most `ranges` rows
    upto = counted.withColumn("upto", F.sum("n").over(Window.orderBy("place")))
    rank = F.greatest(F.ceil(known.agg(F.count(F.lit(1))).scalar() * F.lit(float(q))), F.lit(1))
    chosen = upto.where(F.col("upto") >= rank)
    found = chosen.agg(F.min_by("place", "place")).scalar()
    before = chosen.agg(F.min_by(F.col("upto") - F.col("n"), F.col("place"))).scalar()
    inside = placed.where(F.col("place") == found).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ordered = inside.withColumn("upto", before + F.sum("n").over(Window.orderBy("v")))
    return ordered.where(F.col("upto") >= rank).agg(F.min("v").alias("value"))
