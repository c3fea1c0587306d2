"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import checkpointed

FOREST_ROWS = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one task, as stars: never more rows than links, and the same components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def stars() -> pa.RecordBatch:
        pairs = [(x, r) for x in parent if (r := root(x)) != x]
        u, v = (np.array(side, np.int64) for side in (zip(*pairs, strict=True) if pairs else ((), ())))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        if len(parent) > FOREST_ROWS:
            yield stars()
            parent.clear()
    yield stars()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node it can reach, itself included.

    links has two columns of bigint in any order; rows with a null or with equal ends link nothing. Each round
    hangs the larger neighbours of a node, then the smaller ones, on its smallest neighbour; the rounds needed
    grow with the logarithm of the longest path. Rounds are kept in the shared folder. All steps are joins and
    minimum aggregates, so a node with very many links is split like any skewed join.
    """
    a, b = (F.col(c) for c in links.columns[:2])
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(a.isNotNull() & b.isNotNull() & (a != b))
    edges = checkpointed(edges.mapInArrow(_forest, "u long, v long").distinct())
    before = None
    while True:
        edges = checkpointed(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = tuple(now)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
