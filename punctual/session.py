"""Session builder: settings a punctuality job wants, none of which change results."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more exchange for the aggregate above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash the smaller side of a shuffled join instead of sorting both, where every part of it was measured
    # to be this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(
    app_name: str = "punctual",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the settings above.

    On a cluster leave `master` and `shuffle_partitions` unset, so that what spark-submit says holds;
    adaptive execution merges small shuffle partitions, so a high number is safe.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
