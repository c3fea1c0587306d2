"""Writers. Settings that matter are given per write and never set on the session."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual import schemas


ROWS = "rows"
Counts = dict[str, dict[str, int]]


def write_tables(
    tables: Mapping[str, DataFrame], directory: str, at_once: int = 4, not_null: Mapping[str, Iterable[str]] | None = None
) -> Counts:
    """Full refresh, one Parquet directory per table. The jobs are independent and share the cluster.

    Returns for each table what the writing pass saw, without a further job: its rows (`ROWS`) and the NULLs
    of the columns that `not_null` names for it.
    """
    not_null = not_null or {}

    def write(name: str) -> dict[str, int]:
        columns = list(not_null.get(name, ()))
        seen = Observation()
        nulls = (F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns))
        watched = tables[name].observe(seen, F.count(F.lit(1)).alias(ROWS), *nulls)
        watched.write.mode("overwrite").parquet(f"{directory}/{name}")
        # a table that the planner knows to be empty is written without its counters
        counted = seen.get
        return {ROWS: counted.get(ROWS, 0)} | {c: counted.get(f"null_{i}", 0) for i, c in enumerate(columns)}

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tables, pool.map(write, tables), strict=True))


MANIFEST = "CURRENT"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small file, put in place whole: a reader sees what was there before or all of the new text."""
    target, system = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), system.getConf())
    context.rename(system.makeQualified(draft), system.makeQualified(target), options)


def current_version(spark: SparkSession, directory: str) -> str | None:
    """The folder of the version that readers are to see, None before the first."""
    path = f"{directory}/{MANIFEST}"
    if not path_exists(spark, path):
        return None
    return f"{directory}/{spark.read.text(path).first().value}"


def commit_version(spark: SparkSession, directory: str, version: str) -> None:
    """From now on readers see this version, with all of its tables at once."""
    write_text(spark, version, f"{directory}/{MANIFEST}")


def new_version() -> str:
    return f"version-{uuid.uuid4().hex}"


def read_committed(spark: SparkSession, directory: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Tables of one committed version; the manifest is read once, so they belong together."""
    folder = current_version(spark, directory)
    if folder is None:
        raise FileNotFoundError(f"nothing was committed in {directory}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def write_delay_events(events: DataFrame, path: str) -> None:
    """Full refresh of the event table, one partition per service date.

    Rebalancing gathers a date into few files of a good size, and splits a date too large for one.
    """
    events.hint("rebalance", "service_date").write.mode("overwrite").partitionBy("service_date").parquet(path)


def replace_days(rows: DataFrame, path: str, day: str = "source_date") -> None:
    """Idempotent load: replaces the days present in `rows` and leaves all others alone."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def replace_delay_events(events: DataFrame, path: str, days: Sequence[str]) -> None:
    """Reload of some service dates: each of `days` then holds what `events` has for it, all other days stay.

    A day that has no events any more is removed once the others are written.
    """
    spark = events.sparkSession
    before = _days_stored(spark, path, days)
    replace_days(events.where(F.col("service_date").isin(*days)).hint("rebalance", "service_date"), path, "service_date")
    for day, files in before.items():
        # a partition that still has the files from before got no new ones
        if _days_stored(spark, path, [day]).get(day) == files:
            where, system = _file_system(spark, f"{path}/service_date={day}")
            system.delete(where, True)


def _days_stored(spark: SparkSession, path: str, days: Sequence[str]) -> dict[str, list[str]]:
    """The names of the files of those of the days that are stored."""
    found = {}
    for day in days:
        where, system = _file_system(spark, f"{path}/service_date={day}")
        if system.exists(where):
            found[day] = sorted(status.getPath().getName() for status in system.listStatus(where))
    return found


def read_delay_events(spark: SparkSession, path: str, schema: T.StructType = schemas.DELAY_EVENTS) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_jdbc(tables: Mapping[str, DataFrame], url: str, batch_rows: int = 5000, **properties: str) -> None:
    """The tables, in the order given, to a relational database; values are always bound.

    Executors insert on their own, in batches; nothing passes through the driver.
    """
    for name, table in tables.items():
        table.write.jdbc(url, name, mode="overwrite", properties={"batchsize": str(batch_rows), **properties})


def write_model_comparison(rows: DataFrame, path: str) -> None:
    """The comparison table (a handful of rows) as one CSV file with a header."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    where, system = _file_system(spark, path)
    return system.exists(where)


def read_model_comparison(spark: SparkSession, path: str) -> DataFrame | None:
    """The comparison table, None if it was never written."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(schemas.MODEL_COMPARISON).option("header", True).csv(path)
