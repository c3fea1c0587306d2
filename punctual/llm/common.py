"""What the operators share: tables, the shared folder, slices of Arrow batches, cached pieces of text."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20
_KEPT: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where a local session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="punctual-llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, and a lost executor loses nothing."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df in the shared folder until nothing refers to it: for the rounds of iterative operators."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_bytes(column: str = "text") -> F.Column:
    """A text as UTF-8 bytes; null is the empty text."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"")).alias(column)


def row_key(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> F.Column:
    """Equal for rows of equal id and text only, so one result row per key serves repeated rows."""
    return F.xxhash64(F.col(id_column), F.col(text_column), F.length(text_column))


def set_aside(df: DataFrame) -> list[F.Column]:
    """All columns of df under names (`column0`, ...) that no operator uses; see `restored`."""
    return [F.col("`" + c.replace("`", "``") + "`").alias(f"column{i}") for i, c in enumerate(df.columns)]


def restored(df: DataFrame) -> list[F.Column]:
    """The columns that `set_aside` renamed, as df has them."""
    return [F.col(f"column{i}").alias(c) for i, c in enumerate(df.columns)]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds about `limit` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(byte_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_lengths(column: pa.Array) -> np.ndarray:
    offsets = offsets_of(column)
    return np.diff(offsets).astype(np.int64)


def offsets_of(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[column.offset : column.offset + len(column) + 1]


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in a row, and where each value starts (one more entry: the end)."""
    offsets = offsets_of(column).astype(np.int64)
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def kept_by_worker(name: str, make: Callable):
    """What a worker keeps from task to task, made at its first one."""
    if name not in _KEPT:
        let_go()
        _KEPT[name] = make()
    return _KEPT[name]


def let_go() -> None:
    """What a worker has kept goes: it serves one operator after another, beside the memory of its executor."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Memory that a task has freed goes back to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def uncollected():
    """No search for cycles meanwhile: long lists of pieces have none, and are looked through again and again."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


def mix(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit name of a tuple of numbers, the same in every task."""
    with np.errstate(over="ignore"):
        out = np.full(parts[0].shape, 0x9E3779B97F4A7C15, np.uint64)
        for part in parts:
            out = (out ^ part.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(29)
            out *= np.uint64(0x94D049BB133111EB)
            out ^= out >> np.uint64(32)
    return out


class _Numbers(dict):
    """Pieces by number: one that is asked for the first time takes the next number and is listed."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, piece) -> int:
        self.new.append(piece)
        self[piece] = number = len(self)
        return number


class PieceCache:
    """Values of pieces of text that recur: each piece is worked out once per worker.

    `compute` takes distinct pieces and returns an array or a list of numbers per piece. After `limit` pieces a
    new generation begins; a piece that is met again is taken over from the one before, which then goes. The
    limit bounds memory only, no result depends on it.
    """

    def __init__(self, compute: Callable[[list], Sequence[np.ndarray]], limit: int = 400_000, dtype=np.int32):
        self.compute, self.limit, self.dtype = compute, limit, dtype
        self.clear()

    def clear(self) -> None:
        self.index = _Numbers()
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, self.dtype)
        self.used = 0
        self.before: tuple | None = None

    def _next_generation(self) -> None:
        before = (self.index, self.starts, self.lengths, self.flat)
        self.clear()
        self.before = before

    def places(self, pieces: list) -> np.ndarray:
        if len(self.index) > self.limit:
            self._next_generation()
        places = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        if new := self.index.new:
            self.index.new = []
            numbers = np.arange(len(self.index) - len(new), len(self.index))
            if self.before is not None:
                known, starts, lengths, flat = self.before
                at = np.fromiter(map(known.get, new, repeat(-1)), np.int64, len(new))
                old = at >= 0
                self._add(numbers[old], [flat[starts[i] : starts[i] + lengths[i]] for i in at[old].tolist()])
                numbers, new = numbers[~old], [p for p, i in zip(new, at.tolist(), strict=True) if i < 0]
            self._add(numbers, self.compute(new) if new else [])
        return places

    def _add(self, numbers: np.ndarray, values: Sequence) -> None:
        lengths = np.fromiter(map(len, values), np.int64, len(values))
        if len(values) and isinstance(values[0], np.ndarray):
            flat = np.concatenate(values).astype(self.dtype)
        else:
            flat = np.fromiter(chain.from_iterable(values), self.dtype)
        while len(self.index) > self.starts.size:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        while self.used + flat.size > self.flat.size:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.starts[numbers] = self.used + np.cumsum(lengths) - lengths
        self.lengths[numbers] = lengths
        self.flat[self.used : self.used + flat.size] = flat
        self.used += flat.size

    def expand(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of these pieces one after another, and how many each has."""
        lengths = self.lengths[places]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if ends.size else 0
        at = np.repeat(self.starts[places] - (ends - lengths), lengths) + np.arange(total)
        return self.flat[at], lengths


def sums_by_row(values: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """Sums of runs of `values`; per_row says how many belong to each row (0 allowed)."""
    ends = np.concatenate([[0], np.cumsum(values)])
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    return ends[bounds[1:]] - ends[bounds[:-1]]
