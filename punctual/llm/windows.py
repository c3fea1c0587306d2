"""Windows of fixed length that occur more than once, for the two substring operators.

A window has an anchor: a stretch inside it that is chosen by the window's content alone, so equal windows have
equal anchors at equal places. Neighbouring windows with the same anchor form a gap. A gap is one row: the name
of its anchor, and its class, which is the name of the text of all its windows. An anchor met once settles that
its windows are met once; one with a single class, that all of them are repeated. Only where an anchor has gaps
of several classes may single windows of different classes be equal: the windows of one gap of each class are
named and compared.

So what is moved are rows of a few numbers, one for some dozen words of text, and single windows only around the
ends of repeated passages. A passage that very many rows share is a class with a large count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import let_go, mix, row_key, slices, stored, text_bytes

LAST = (1 << 63) - 1  # stands for a null id, after all others
POSITION_BITS = 30
# The classes of an anchor, some 600 bytes each, are compared in one task up to this number (10 MB); with more
# of them its windows are spread over all tasks, with the same outcome.
CLASSES_TOGETHER = 16_384
TOGETHER = 50_000  # classes of several anchors that are laid out at once
GAPS = "doc long, key long, name long, cls long, lo int, n int"

# Units of a row of texts, where each text starts (one more: the end) -> what `gaps_of` needs.
Scan = Callable[[np.ndarray, np.ndarray], "Scanned"]


class Scanned:
    """Anchors of all windows of a row of texts, worked out where they are asked for, and names of windows."""

    def __init__(self, bounds: np.ndarray, size: int, anchors: Callable[[], tuple[np.ndarray, np.ndarray]], window_names: Callable[[np.ndarray], np.ndarray]):
        self.bounds, self.size = bounds, size
        self.anchors = anchors  # by window: the place of its anchor, and the anchor's name
        self.window_names = window_names

    def gaps(self) -> dict[str, np.ndarray]:
        """Runs of windows with the same anchor; `text` is the number of the text they are in."""
        counts = np.maximum(np.diff(self.bounds) - self.size + 1, 0)
        text = np.repeat(np.arange(len(counts)), counts)
        window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + self.bounds[text]
        if not len(window):
            return {k: np.zeros(0, np.int64) for k in ("text", "name", "cls", "lo", "n")}
        anchor, names = (x[window] for x in self.anchors())
        begins = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (names[1:] != names[:-1])]))
        ends = np.concatenate([begins[1:], [len(window)]]) - 1
        low, high = window[begins], window[ends]
        n = high - low + 1
        # two windows name the whole text of a gap as long as they touch, and gaps are shorter than windows
        cls = mix(self.window_names(low), self.window_names(high), (anchor[begins] - low).astype(np.uint64), n.astype(np.uint64))
        return {"text": text[begins], "name": names[begins], "cls": cls, "lo": low - self.bounds[text[begins]], "n": n}


def range_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of values[i : i + width] for every i that has so many."""
    n = len(values)
    if n < width:
        return values[:0]
    rows = -(-n // width)
    grid = np.full(rows * width, np.iinfo(values.dtype).max, values.dtype)
    grid[:n] = values
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def keyed_texts(docs: DataFrame, id_column: str, text_column: str, *more: str) -> DataFrame:
    """doc and key (a row's identity, the same for repeated rows), text as bytes, the id as it was, and more columns."""
    rows = docs.select(
        F.coalesce(F.col(id_column), F.lit(LAST)).alias("doc"),
        row_key(docs, id_column, text_column).alias("key"),
        F.col(id_column).alias("id"),
        *(F.col(c) for c in more),
        text_bytes(text_column).alias("text"),
    )
    return rows


def gaps_of(texts: DataFrame, make_scan: Callable[[], Callable], limit: int = 1 << 20) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        scan = make_scan()
        for batch in slices(batches, limit=limit):
            found = scan(batch.column("text")).gaps()
            text = found["text"]
            columns = [np.asarray(batch.column(c))[text] for c in ("doc", "key")]
            columns += [found["name"].view(np.int64), found["cls"].view(np.int64), found["lo"].astype(np.int32), found["n"].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "key", "name", "cls", "lo", "n"])

    return texts.select("doc", "key", "text").mapInArrow(run, GAPS)


def _first_of_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of repeated rows, which have the same text and the same spots, one for each task."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        new = []
        for at, key in enumerate(zip(batch.column("doc").to_pylist(), batch.column("key").to_pylist(), strict=True)):
            if key not in seen:
                seen.add(key)
                new.append(at)
        yield batch if len(new) == batch.num_rows else batch.take(pa.array(new, pa.int64()))


def _bodies(make_scan: Callable[[], Callable], limit: int):
    """Texts with their spots (lo, n, name, cls, value, copies) to one row per spot with `windows`, the names of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = make_scan()
        for batch in slices(_first_of_key(batches), limit=limit):
            scanned, spots = scan(batch.column("text")), batch.column("spots")
            per_text = np.diff(np.asarray(spots.offsets))
            flat = spots.flatten()
            low = np.asarray(flat.field("lo")).astype(np.int64) + np.repeat(scanned.bounds[:-1], per_text)
            n = np.asarray(flat.field("n")).astype(np.int64)
            ends = np.cumsum(n)
            offset = np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n)
            names = scanned.window_names(np.repeat(low, n) + offset).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(names))
            yield pa.RecordBatch.from_arrays([*(flat.field(c) for c in ("name", "cls", "value", "copies")), lists], ["name", "cls", "value", "copies", "windows"])

    return run


def _settle(earlier: bool):
    """Classes of an anchor name, side by side, to the best value of each of their windows, in runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ends, first = np.cumsum(np.diff(np.asarray(batch.column("classes").offsets))), 0
            while first < batch.num_rows:
                before = ends[first - 1] if first else 0
                stop = max(first + 1, int(np.searchsorted(ends, before + TOGETHER, side="right")))
                yield _settled(batch.slice(first, stop - first), earlier)
                first = stop

    return run


def _settled(batch: pa.RecordBatch, earlier: bool) -> pa.RecordBatch:
    groups = batch.column("classes")
    flat = groups.flatten()
    group = np.repeat(np.arange(len(groups)), np.diff(np.asarray(groups.offsets)))
    cls, value, copies = (np.asarray(flat.field(c)) for c in ("cls", "value", "copies"))
    lists = flat.field("windows")
    n = np.diff(np.asarray(lists.offsets)).astype(np.int64)
    window = np.asarray(lists.flatten())
    owner = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    order = np.lexsort((window, group[owner]))
    w, g = window[order], group[owner][order]
    begins = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (g[1:] != g[:-1])])) if len(w) else np.zeros(0, np.int64)
    merged = (np.minimum if earlier else np.add).reduceat(value[owner][order], begins) if len(w) else np.zeros(0, np.int64)
    best = np.empty(len(w), np.int64)
    best[order] = np.repeat(merged, np.diff(np.concatenate([begins, [len(w)]])))
    some = (best < value[owner]) | (copies[owner] > 1) if earlier else best > 1
    owner, offset, best = owner[some], offset[some], best[some]
    if not earlier:
        best = np.zeros_like(best)  # that it is repeated is all that counts
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1) | (best[1:] != best[:-1])]) if len(owner) else np.zeros(0, bool)
    begins = np.flatnonzero(new)
    ends = np.concatenate([begins[1:], [len(owner)]]) - 1 if len(begins) else begins
    names = np.asarray(batch.column("name"))[group[owner[begins]]]
    columns = [names, cls[owner[begins]], offset[begins].astype(np.int32), offset[ends].astype(np.int32), best[begins]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["name", "cls", "first", "last", "value"])


def repeated_windows(gaps: DataFrame, texts: DataFrame, make_scan: Callable[[], Callable], earlier: bool, limit: int = 1 << 20) -> DataFrame:
    """(doc, key, spans): for each row the starts of repeated windows, as arrays of (first, last).

    earlier: a window counts if it also starts in a row of a smaller id. Otherwise it counts if it starts
    anywhere else, the same row included. `gaps` is read twice and should be a stored table.
    """
    least = [F.min("doc").alias("least")] if earlier else []
    names = gaps.groupBy("name").agg(F.count("*").alias("total"), F.min("cls").alias("a"), F.max("cls").alias("b"), *least)
    names = names.where("total > 1").withColumn("several", F.col("a") != F.col("b")).drop("total", "a", "b")
    # stored, so that the join deals out both sides anew and a name with very many gaps can be split
    names = stored(names, "anchor-names")
    met = stored(gaps.join(names, "name"), "gaps-met")
    # an anchor with one class: all its windows are repeated
    alone = met.where("not several" + (" and least < doc" if earlier else ""))
    hits = alone.select("doc", "key", F.col("lo").alias("first"), (F.col("lo") + F.col("n") - 1).alias("last"))
    # with several classes: the windows of one gap of each are compared
    several = met.where("several").select("doc", "key", "name", "cls", "lo", "n")
    value = F.min("doc") if earlier else F.count("*")
    # one spot of each class: a repeated row has many, and so has a text that repeats itself
    spot = (F.min("key").alias("rep"), F.min_by("doc", "key").alias("doc"), F.min_by("lo", "key").alias("lo"), F.min("n").alias("n"))
    classes = several.groupBy("name", "cls").agg(value.alias("value"), F.count("*").alias("copies"), *spot)
    sizes = classes.groupBy("name").agg(F.count("*").alias("size"))
    spots = classes.join(sizes, "name").withColumnRenamed("rep", "key")
    bodies = "name long, cls long, value long, copies long, windows array<long>"

    def asked(some: DataFrame) -> DataFrame:
        per_text = some.groupBy("doc", "key").agg(F.collect_list(F.struct("lo", "n", "name", "cls", "value", "copies")).alias("spots"))
        return texts.join(per_text.hint("shuffle_hash"), ["doc", "key"]).mapInArrow(_bodies(make_scan, limit), bodies)

    grouped = asked(spots.where(f"size <= {CLASSES_TOGETHER}")).groupBy("name").agg(F.collect_set(F.struct("cls", "value", "copies", "windows")).alias("classes"))
    few = grouped.mapInArrow(_settle(earlier), "name long, cls long, first int, last int, value long")
    # an anchor with very many classes: its windows are spread, and their best values come back by a join
    windows = asked(spots.where(f"size > {CLASSES_TOGETHER}")).dropDuplicates(["name", "cls"]).select("name", "cls", "value", "copies", F.posexplode("windows").alias("first", "window"))
    best = windows.groupBy("name", "window").agg((F.min("value") if earlier else F.sum("value")).alias("best"))
    useful = "best < value or copies > 1" if earlier else "best > 1"
    many = windows.join(best, ["name", "window"]).where(useful).select("name", "cls", "first", F.col("first").alias("last"), (F.col("best") if earlier else F.lit(0).cast("long")).alias("value"))
    verdicts = few.union(many).groupBy("name", "cls").agg(F.collect_set(F.struct("first", "last", "value")).alias("pieces"))
    # joined by a key that nothing is dealt by yet: both sides are dealt out anew, and a class with very many gaps can be
    # split. Not stored for that: in one query with `cut_texts`, the exchange of the texts is used again
    own = F.xxhash64("name", "cls").alias("own")
    judged = several.select("*", own).join(verdicts.select("*", own), ["own", "name", "cls"]).select("doc", "key", "lo", F.inline("pieces"))
    if earlier:
        judged = judged.where("value < doc")
    hits = hits.union(judged.select("doc", "key", (F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last")).alias("last")))
    return hits.groupBy("doc", "key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def covered(length: int, spans: list[tuple[int, int]] | None, size: int) -> np.ndarray:
    """A flag per unit of a text: it lies in a window that starts in one of the spans."""
    change = np.zeros(length + 1, np.int64)
    if spans:
        first, last = np.array(spans, np.int64).T
        np.add.at(change, first, 1)
        np.add.at(change, np.minimum(last + size, length), -1)
    return np.cumsum(change[:length]) > 0


def cut_texts(texts: DataFrame, spans: DataFrame, cut: Callable[[pa.RecordBatch], list[pa.Array]], names: list[str], schema: str, *more: str) -> DataFrame:
    """`cut` over every text with its spans; id and more columns go through."""

    # the texts are dealt as for the comparison of windows, so that Spark can use the same exchange again
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = [batch.column(c) for c in ("id", *more)]
            yield pa.RecordBatch.from_arrays([*kept, *cut(batch)], ["id", *more, *names])

    marked = texts.join(spans.hint("shuffle_hash"), ["doc", "key"], "left")
    types = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in ("id", *more))
    return marked.mapInArrow(run, f"{types}, {schema}")


def span_lists(batch: pa.RecordBatch) -> list[list[tuple[int, int]] | None]:
    return [x and [(s["first"], s["last"]) for s in x] for x in batch.column("spans").to_pylist()]
