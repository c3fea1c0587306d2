"""Tables that outlive the plan that made them, kept in the cluster's shared folder.

Writing a table cuts the lineage, survives the loss of executors (cached blocks do not), and tells the
planner the true size of what it reads next, so that it broadcasts what is small and only that.
"""

from __future__ import annotations

import hashlib
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from punctual.sources.sinks import path_exists

Stage = Callable[[DataFrame, str], DataFrame]

_lock = threading.RLock()
_written: set[str] = set()
_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """This application's part of `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own.
    """
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        with _lock:
            _own_folder = _own_folder or tempfile.mkdtemp(prefix="run-")
        named = _own_folder
    return f"{named.rstrip('/')}/punctual-{spark.sparkContext.applicationId}"


def written_once(spark: SparkSession, source: str, name: str, write: Callable[[str], None]) -> str:
    """The path of the table `name` derived from `source`; `write(path)` runs unless this application
    has written it already and it is still there."""
    path = f"{shared_folder(spark)}/{hashlib.md5(source.encode()).hexdigest()[:12]}/{name}"
    with _lock:
        if path not in _written or not path_exists(spark, path):
            write(path)
            _written.add(path)
    return path


def stage_tables(spark: SparkSession) -> Stage:
    """A function that stores an intermediate table under a fresh path and reads it back."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"

    def stage(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    return stage


def keep_lazy(rows: DataFrame, name: str) -> DataFrame:
    """The stage that stores nothing: one plan from end to end, fit for small inputs."""
    return rows
