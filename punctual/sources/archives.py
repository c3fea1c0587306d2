"""Position archives as a Spark data source: zips of zips, read where a plan asks for them.

    archives.register(spark)
    spark.read.format("position_archives").options(**archives.options({"20260701": path})).load()

Partitions are planned from the directories of the archives: each takes a stretch of neighbouring entries of one
archive, cut by their packed size, so there is no listing job and no shuffle. Which days, which ordinals and which
sample are wanted is said in the options: an archive of another day is not opened, an entry that is not asked for is
not read. The source doesn't take over filters of a plan: Spark 4.1 keeps the filters of a relation's first scan for
all its scans, so two filters on one table would both see the rows of the first (tested).
"""

from __future__ import annotations

import io
import json
import zipfile
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "position_archives"
SNAPSHOT_MEMBER = "siri.xml"  # fixed value: the file inside each snapshot
TASK_BYTES = 64 << 20  # of packed snapshots for one task
BATCH_BYTES = 32 << 20  # of documents that are handed over at once

LISTED = "source_date string, archive string, ordinal bigint, snapshot_file string, size bigint"
READ = f"{LISTED}, xml binary, damage string"
# What a damaged zip or one of its entries raises: bad headers and checksums, streams that are broken or end
# early, unknown methods, encryption.
DAMAGE = (zipfile.BadZipFile, zlib.error, EOFError, KeyError, NotImplementedError, RuntimeError)

Archives = Mapping[str, "str | Sequence[str]"]  # by service date


def file_system(path: str):
    """The file system of a local, mounted or object-store path, and the path there."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


class _Handle(io.RawIOBase):
    """An Arrow file as `zipfile` expects one: a seek before the start is an OSError."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        to = offset + (0, self.file.tell(), self.file.size())[whence]
        if to < 0:
            raise OSError(f"seek to {to}")
        return self.file.seek(to)

    def readinto(self, buffer) -> int:
        found = self.file.read(len(buffer))
        buffer[: len(found)] = found
        return len(found)

    def close(self) -> None:
        self.file.close()
        super().close()


def open_file(path: str) -> io.BufferedReader:
    filesystem, inner = file_system(path)
    return io.BufferedReader(_Handle(filesystem.open_input_file(inner)), 1 << 20)


def snapshot_xml(outer: zipfile.ZipFile, entry: zipfile.ZipInfo) -> tuple[bytes | None, str | None]:
    """The document of one packed snapshot, or what is wrong with it. An empty entry is no fault."""
    try:
        packed = outer.read(entry)
        if not packed:
            return None, None
        with zipfile.ZipFile(io.BytesIO(packed)) as inner:
            return inner.read(SNAPSHOT_MEMBER), None
    except DAMAGE as fault:
        return None, f"{type(fault).__name__}: {fault}"


def entries(outer: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """The snapshots in the order of the directory; other files are none."""
    return [e for e in outer.infolist() if e.filename.endswith(".zip")]


@dataclass
class Stretch(InputPartition):
    """Neighbouring entries of one archive; those that a sample or a filter leaves out are jumped over."""

    source_date: str
    archive: str
    first: int
    last: int


class Reader(DataSourceReader):
    def __init__(self, options: Mapping[str, str], with_content: bool):
        self.archives = [tuple(pair) for pair in json.loads(options["archives"])]
        self.every = max(1, int(options.get("everynth", "1")))
        self.task_bytes = int(options.get("taskbytes", str(TASK_BYTES)))
        self.with_content = with_content
        self.first, self.last = int(options.get("first", "0")), int(options["last"]) if options.get("last") else None

    def _chosen(self, found: list[zipfile.ZipInfo], first: int = 0, last: int | None = None) -> list[int]:
        """Ordinals of a sample from the first entry on, as far as they are asked for."""
        ends = [len(found) - 1, *(x for x in (self.last, last) if x is not None)]
        return [i for i in range(0, min(ends) + 1, self.every) if i >= max(self.first, first)]

    def partitions(self) -> list[Stretch]:
        out = []
        for date, archive in self.archives:
            with open_file(archive) as handle, zipfile.ZipFile(handle) as outer:
                found = entries(outer)
            held, first, last = 0, None, None
            for i in self._chosen(found):
                if first is not None and held + found[i].compress_size > self.task_bytes:
                    out.append(Stretch(date, archive, first, last))
                    held, first = 0, None
                held, first, last = held + found[i].compress_size, i if first is None else first, i
            if first is not None:
                out.append(Stretch(date, archive, first, last))
        return out

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing is asked for
            return
        with open_file(partition.archive) as handle, zipfile.ZipFile(handle) as outer:
            found, rows, held = entries(outer), [], 0
            for i in self._chosen(found, partition.first, partition.last):
                row = (partition.source_date, partition.archive, i, found[i].filename, found[i].compress_size)
                if self.with_content:
                    xml, damage = snapshot_xml(outer, found[i])
                    row, held = (*row, xml, damage), held + len(xml or b"")
                rows.append(row)
                if held > BATCH_BYTES or len(rows) >= 10_000:
                    yield self._batch(rows)
                    rows, held = [], 0
            if rows:
                yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        names = ["source_date", "archive", "ordinal", "snapshot_file", "size", "xml", "damage"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(columns)])


class PositionArchives(DataSource):
    """Options: archives (JSON pairs of service date and path), everyNth, first and last (ordinals, both included),
    taskBytes, content (false: listing only)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _with_content(self) -> bool:
        return self.options.get("content", "true").lower() == "true"

    def schema(self) -> str:
        return READ if self._with_content() else LISTED

    def reader(self, schema: StructType) -> Reader:
        return Reader({k.lower(): v for k, v in self.options.items()}, self._with_content())


def options(
    archives: Archives, every_nth: int = 1, first: int = 0, last: int | None = None, task_bytes: int = TASK_BYTES, content: bool = True
) -> dict[str, str]:
    pairs = [(date, path) for date, paths in sorted(archives.items()) for path in ([paths] if isinstance(paths, str) else paths)]
    out = {"archives": json.dumps(pairs), "everyNth": str(every_nth), "first": str(first), "taskBytes": str(task_bytes), "content": str(content).lower()}
    return out if last is None else out | {"last": str(last)}


def register(spark: SparkSession) -> None:
    """Makes the format known to the session."""
    spark.dataSource.register(PositionArchives)


def read_archives(spark: SparkSession, archives: Archives, **settings) -> DataFrame:
    """One row per snapshot, numbered from 0 in the order of its archive's directory.

    xml holds the document, null where there is none; damage says why. Settings as for `options`.
    """
    register(spark)
    return spark.read.format(FORMAT).options(**options(archives, **settings)).load()
