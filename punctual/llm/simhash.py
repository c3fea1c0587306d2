"""Operator 7: near-duplicates by SimHash and the generalised pigeonhole principle.

Two fingerprints of 64 bits that differ in at most t bits, cut into m groups of bits with thresholds whose sum
is t - m + 1, agree in some group up to its threshold. Groups are made of correlated bits, found from counts over
all fingerprints. Each fingerprint gets thresholds of its own (-1: the group is not looked at), by dynamic
programming on the number of keys to probe and the candidates they are estimated to bring. Every fingerprint is
filed under its m group values and asks under the values near its own; candidates are verified by counting bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import restored, row_key, set_aside, slices, stored, table, text_bytes
from punctual.llm.components import components

BITS = 64
MAX_DISTANCE = 3
SEED = 42
SKETCH_BITS = 13
FEW = 1 << 24  # distinct fingerprints
PROBE_COST = 1.0  # of one probed key, in candidates
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, words: int = 3) -> int:
    """The SimHash of a text: one vote per shingle and bit; a tie gives 0; no words give 0."""
    from xxhash import xxh64_intdigest

    split = text.translate(LOWER).split()
    if not split:
        return 0
    if len(split) < words:
        hashes = [xxh64_intdigest(b" ".join(split), SEED)]
    else:
        hashes = [xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(split[i:] for i in range(words)))]  # noqa: B905
    return of_hashes(hashes)


def of_hashes(hashes: list[int] | np.ndarray) -> int:
    """The SimHash of what has these hashes of 64 bits; none give 0."""
    votes = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 50_000):
        some = np.array(hashes[first : first + 50_000], ">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3) -> DataFrame:
    """id and fp (the 64 bits as a signed bigint) of every row; null text counts as empty."""
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_bytes(text_column).alias("text"))
    return rows.mapInArrow(_fingerprints(words), f"id {kind}, fp long")


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        bits = _bits(np.asarray(batch.column("fp")).view(np.uint64)).astype(np.float64)
        total += (bits.T @ bits).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel())], ["pair", "n"])


def bit_groups(nodes: DataFrame, n: int, groups: int) -> list[list[int]]:
    """Bits in groups of equal size, each begun by a free bit and filled with those most correlated with it."""
    both = np.zeros(BITS * BITS)
    for row in nodes.select("fp").mapInArrow(_bit_counts, "pair long, n long").groupBy("pair").sum("n").collect():
        both[row[0]] = row[1]
    both = both.reshape(BITS, BITS) / max(n, 1)
    ones = np.diag(both)
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-12))
    correlation = np.abs(both - np.outer(ones, ones)) / np.outer(spread, spread)
    free, found = list(range(BITS)), []
    for g in range(groups):
        size = (BITS - g - 1) // groups + 1
        chosen = [free.pop(0)]
        while len(chosen) < size:
            best = max(free, key=lambda bit: (correlation[bit, chosen].sum(), -bit))
            free.remove(best)
            chosen.append(best)
        found.append(sorted(chosen))
    return found


class Pigeonholes:
    """Group values, thresholds and probes of fingerprints."""

    def __init__(self, groups: list[list[int]], max_distance: int = MAX_DISTANCE):
        self.groups, self.t = groups, max_distance
        self.sketch: list[np.ndarray] | None = None
        self.masks = [self._masks(len(bits)) for bits in groups]

    def _masks(self, width: int) -> list[np.ndarray]:
        """The differences of exactly r bits, for r = 0 to t."""
        return [np.array([sum(1 << i for i in c) for c in combinations(range(width), r)], np.int64) for r in range(self.t + 1)]

    def values(self, fps: np.ndarray) -> np.ndarray:
        """(groups, rows): the bits of each group as a number."""
        bits = _bits(fps).astype(np.int64)
        return np.stack([(bits[:, g] << np.arange(len(g))).sum(axis=1) for g in self.groups])

    @staticmethod
    def bucket(values: np.ndarray) -> np.ndarray:
        return ((values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)

    def costs(self, values: np.ndarray, g: int) -> np.ndarray:
        """(t + 2, rows): probes and estimated candidates of group g at threshold -1, 0, ... t."""
        counts = self.sketch[g]
        share = (1 << SKETCH_BITS) / max(1, 1 << len(self.groups[g]))
        mean = counts.mean()
        seen = counts[self.bucket(values)] * min(1.0, share)
        width, out, total = len(self.groups[g]), [np.zeros(values.shape)], np.zeros(values.shape)
        for r in range(self.t + 1):
            n = comb(width, r)
            near = seen if r == 0 else n * mean * min(1.0, share)
            total = total + n * PROBE_COST + near
            out.append(total)
        return np.stack(out)

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """(groups, rows): by dynamic programming over the groups; t + 1 units, a threshold of k takes k + 1."""
        units, rows = self.t + 1, values.shape[1]
        best = np.full((units + 1, rows), np.inf)
        best[0] = 0
        chosen = np.zeros((len(self.groups), units + 1, rows), np.int64)
        for g in range(len(self.groups)):
            cost = self.costs(values[g], g)
            following = np.full_like(best, np.inf)
            for have in range(units + 1):
                for take in range(have + 1):
                    sum_ = best[have - take] + cost[take]
                    better = sum_ < following[have]
                    following[have][better] = sum_[better]
                    chosen[g, have][better] = take
            best = following
        out, left = np.zeros((len(self.groups), rows), np.int64), np.full(rows, units)
        for g in reversed(range(len(self.groups))):
            take = chosen[g, left, np.arange(rows)]
            out[g] = take - 1
            left = left - take
        return out

    def key(self, g: int, values: np.ndarray) -> np.ndarray:
        return (np.int64(g) << np.int64(58)) ^ values

    def filed(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = self.values(fps)
        return np.concatenate([self.key(g, v) for g, v in enumerate(values)]), np.tile(fps, len(self.groups))

    def probes(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = self.values(fps)
        limits = self.thresholds(values)
        keys, owners = [], []
        for g in range(len(self.groups)):
            for r in range(self.t + 1):
                asks = limits[g] >= r
                keys.append((self.key(g, values[g][asks])[:, None] ^ self.masks[g][r]).ravel())
                owners.append(np.repeat(fps[asks], len(self.masks[g][r])))
        return np.concatenate(keys), np.concatenate(owners)


def _keyed(make, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column("fp")).view(np.uint64)
            for first in range(0, len(fps), 2000):
                keys, owners = make(fps[first : first + 2000])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners.view(np.int64))], ["key", name])

    return run


def near_pairs(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(x, y): all pairs of the distinct fingerprints in `nodes` (column fp) that differ in at most max_distance bits.

    Three groups of some 21 bits, or two of 32 for tables so large that unrelated texts often share 21 bits; the
    pairs are the same. Only the smaller of two fingerprints asks. A value that very many share makes a skewed
    join, which is split at run time; only verified pairs leave it.
    """
    n = nodes.count()
    groups = 3 if n < FEW else 2
    holes = Pigeonholes(bit_groups(nodes, n, groups), max_distance)
    filed = nodes.select("fp").mapInArrow(_keyed(holes.filed, "y"), "key long, y long")
    holes.sketch = _sketch(nodes, holes)
    probes = nodes.select("fp").mapInArrow(_keyed(holes.probes, "x"), "key long, x long")
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_distance
    return probes.join(filed, (probes["key"] == filed["key"]) & (F.col("x") < F.col("y")) & near).select("x", "y")


def _sketch(nodes: DataFrame, holes: Pigeonholes) -> list[np.ndarray]:
    """How many fingerprints fall in each hash bucket of each group's values: a fixed number of counters."""
    groups = holes.groups

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(groups), 1 << SKETCH_BITS), np.int64)
        for batch in batches:
            for g, values in enumerate(holes.values(np.asarray(batch.column("fp")).view(np.uint64))):
                total[g] += np.bincount(holes.bucket(values), minlength=1 << SKETCH_BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "n"])

    counts = np.zeros(len(groups) << SKETCH_BITS, np.int64)
    for batch in nodes.select("fp").mapInArrow(count, "at long, n long").groupBy("at").sum("n").collect():
        counts[batch[0]] = batch[1]
    return list(counts.reshape(len(groups), -1))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """id, fp, component_id of every row: the smallest id reachable over links of at most max_distance bits.

    Null, empty and blank texts have fingerprint 0 and link like any other. Rows of equal fingerprint are one
    node, however many. A row without an id has its component, which takes its id from the other rows (null if
    there are none). Further columns are left out; an empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, id_column, text_column, words), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "fingerprint-nodes")
    roots = components(near_pairs(nodes, max_distance))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "fingerprint-roots")
    # a component of one node names itself; only the others need a minimum over their nodes
    shared = named.groupBy("root").agg(F.min("first").alias("component_id"))
    found = named.join(shared, "root").select("fp", "component_id")
    return rows.join(found, "fp").select("id", "fp", "component_id")


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs without near-duplicates: the row of the smallest id of each component stays, its copies go.

    Of rows that share that id and text one stays. Rows without an id come after those with one.
    """
    key = row_key(docs, id_column, text_column)
    order = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), key.alias("key"))
    found = near_duplicates(docs.select(order.alias("id"), F.col(text_column).alias("text")), "id", "text")
    kept = found.where(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id.key").alias("key")).distinct()
    one = docs.select(key.alias("key"), *set_aside(docs)).join(kept, "key", "left_semi")
    return one.dropDuplicates(["key"]).select(*restored(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), shown.alias("fingerprint"), "component_id")
