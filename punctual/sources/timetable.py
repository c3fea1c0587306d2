"""Timetable feed: a directory of CSV files with a header line."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual import schemas


@dataclass(frozen=True)
class Timetable:
    """The seven tables a reconstruction needs."""

    stops: DataFrame
    routes: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    calendar: DataFrame
    calendar_dates: DataFrame
    agency: DataFrame


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text under the names of the header; a byte-order mark and blanks are dropped."""
    raw = spark.read.option("header", True).csv(path)
    return raw.toDF(*(name.lstrip("\ufeff").strip() for name in raw.columns))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, required: list[str] | None = None
) -> DataFrame:
    """CSV under a declared schema, bound **by name**: feeds order their columns as they like.

    A value that does not fit its type becomes NULL, an absent optional column is all NULL, and an absent
    required one is an error.
    """
    raw = read_csv_strings(spark, path)
    missing = [name for name in required or [] if name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return raw.select(
        *(
            (F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def read_timetable(spark: SparkSession, directory: str) -> Timetable:
    """All tables of an unpacked feed (`stops.txt`, `routes.txt`, …)."""
    return Timetable(
        **{
            name: read_csv(spark, f"{directory}/{name}.txt", schema, schemas.REQUIRED[name])
            for name, schema in schemas.TIMETABLE.items()
        }
    )


def read_silver_timetable(spark: SparkSession, directory: str) -> Timetable:
    """The same tables after `sinks.write_tables`."""
    return Timetable(
        **{f.name: spark.read.parquet(f"{directory}/{f.name}") for f in fields(Timetable)}
    )
