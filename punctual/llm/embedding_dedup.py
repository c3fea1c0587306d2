"""Operator 5: near-duplicates of embeddings by NN-descent.

Vectors of a label and a length are compared. Equal vectors become one node with a count. The neighbour graph starts
from a few random-projection orders: vectors are sorted by the signs of their projections, and each gets the best
neighbours from its stretch of that order. Rounds then join every list with the lists it is in, forwards and
backwards: all members of a neighbourhood are compared, block against block, and what improves a list enters it; only
neighbourhoods with something new take part. A list all of whose members reach the threshold is full of links and may
hide more, so it is enlarged and joined again. Links make components while rounds go on, and members of one component
are not compared in rounds: at the end all links inside a component are counted exactly, block against block. So a
dense clump costs the square of its size once, and not once for each of its members.

Rounds end when no list changes. An audit then compares nodes with links or near-links, and others, with all nodes; as
long as it falls short, further orders and rounds follow, and if it still does after AUDITS, that is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import checkpointed, stored, table
from punctual.llm.components import components

THRESHOLD = 0.98
NEIGHBOURS = 10
ORDERS = 6
STRETCH = 256
PART = 512  # members of a node's neighbourhood that are compared at once; all pairs of parts are
BLOCK = 512  # rows of a component that are compared at once
NEAR = 0.1  # a list whose best entry is so little below the threshold belongs to an audited node, too
AUDITED = 500  # nodes with links or near-links, and as many of all nodes
RECALL = 0.99
AUDITS = 6


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision, of vectors of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    largest = np.abs(rows).max(axis=1, keepdims=True)
    if len(rows) and (largest.max() > 1e150 or largest.min() < 1e-150):
        # powers of two, which change no digit, keep the squares finite
        rows = np.ldexp(rows, -np.frexp(largest)[1])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, vectors of one length at a time."""
    lengths = np.asarray(pc.list_value_length(batch.column("vec")))
    for n in np.unique(lengths):
        same = lengths == n
        yield batch if same.all() else batch.filter(pa.array(same))


def _valid(vector: F.Column) -> F.Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, of batches sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
        changed = np.zeros(rows.num_rows - 1, bool)
        for key in keys:
            values = rows.column(key).to_numpy()
            changed |= values[1:] != values[:-1]
        bounds = [0, *(np.flatnonzero(changed) + 1).tolist()]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield rows.slice(a, b - a)
        rest = rows.slice(bounds[-1])
    if rest is not None:
        yield rest


def _array(rows: pa.Table, name: str) -> pa.Array:
    column = rows.column(name)
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _pairs(out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    u, v, cos = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(cos)], ["u", "v", "cos"])


def _best(nodes: np.ndarray, cos: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """For each row its k largest entries of cos, the own one left out."""
    np.fill_diagonal(cos, -2)
    k = min(k, len(nodes) - 1)
    at = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(nodes)), k)
    return nodes[rows], nodes[at.ravel()], cos[rows, at.ravel()]


def _from_orders(seeds: list[int], k: int) -> tuple[Callable, Callable]:
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for mixed in batches:
            for batch in _by_length(mixed):
                x = _matrix(batch.column("vec"))
                for seed in seeds:
                    if (seed, x.shape[1]) not in planes:
                        planes[seed, x.shape[1]] = np.random.default_rng(seed).normal(size=(x.shape[1], 60))
                    code = ((x @ planes[seed, x.shape[1]] > 0).astype(np.int64) << np.arange(59, -1, -1)).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(code), seed, np.int32)), batch.column("label"), pa.array(code), batch.column("node"), batch.column("vec")],
                        ["seed", "label", "code", "node", "vec"],
                    )

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["seed", "label"]):
            # stretches overlap by half, so that no border separates neighbours
            out = []
            for first in range(0, max(1, rows.num_rows - STRETCH // 2), STRETCH // 2):
                some = rows.slice(first, STRETCH)
                if some.num_rows > 1:
                    x = _matrix(_array(some, "vec"))
                    out.append(_best(some.column("node").to_numpy(), x @ x.T, k))
                if len(out) >= 64:
                    yield _pairs(out)
                    out = []
            yield _pairs(out)

    return codes, stretches


def _ordered_pairs(nodes: DataFrame, seeds: list[int], k: int) -> DataFrame:
    codes, stretches = _from_orders(seeds, k)
    kind = nodes.schema["vec"].dataType.simpleString()
    coded = nodes.select("label", "node", "vec").mapInArrow(codes, f"seed int, label long, code long, node long, vec {kind}")
    ranged = coded.repartitionByRange("seed", "label", "code", "node").sortWithinPartitions("seed", "label", "code", "node")
    return ranged.mapInArrow(stretches, "u long, v long, cos double")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two parts of a node's neighbourhood against each other: pairs that a list lacks and wants.

    Of what a node wants here only as many are passed on as its list can hold.
    """
    out, held = [], 0
    for rows in _groups(batches, ["center", "a", "b"]):
        fresh = rows.column("fresh").to_numpy(zero_copy_only=False)
        if rows.num_rows < 2 or not fresh.any():
            continue
        node, root, floor, part = (rows.column(c).to_numpy() for c in ("member", "root", "floor", "part"))
        x = _matrix(_array(rows, "vec"))
        cos = x @ x.T
        wanted = (cos > floor[:, None]) & (fresh[:, None] | fresh[None, :]) & (root[:, None] != root[None, :])
        if rows.column("a")[0].as_py() != rows.column("b")[0].as_py():  # pairs within a part have a group of their own
            wanted &= part[:, None] != part[None, :]
        k = int(rows.column("k").to_numpy().max())
        if k < len(node):
            ranked = np.where(wanted, cos, -2)
            least = np.partition(ranked, len(node) - k, axis=1)[:, len(node) - k]
            wanted &= ranked >= least[:, None]
        one, other = np.nonzero(wanted)
        out.append((node[one], node[other], cos[one, other]))
        held += len(one)
        if held > 50_000:
            yield _pairs(out)
            out, held = [], 0
    yield _pairs(out)


def _lists(pairs: DataFrame, sizes: DataFrame | None, k: int) -> DataFrame:
    """(u, k, list): the k best neighbours of each node; k is a node's own, if sizes has it."""
    best = pairs.groupBy("u", "v").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh"))
    merged = best.groupBy("u").agg(F.sort_array(F.collect_list(F.struct("cos", "v", "fresh")), asc=False).alias("all"))
    merged = merged.withColumn("k", F.lit(k)) if sizes is None else merged.join(sizes, "u", "left").withColumn("k", F.coalesce("k", F.lit(k)))
    return merged.select("u", "k", F.slice("all", 1, F.col("k")).alias("list"))


def _enlarged(lists: DataFrame, threshold: float) -> DataFrame:
    """Full lists of links get room for twice as many; what found no room before is looked for again."""
    full = (F.size("list") >= F.col("k")) & (F.element_at("list", -1)["cos"] >= threshold)
    again = F.transform("list", lambda e: e.withField("fresh", F.lit(True)))
    return lists.select("u", F.when(full, 2 * F.col("k")).otherwise(F.col("k")).alias("k"), F.when(full, again).otherwise(F.col("list")).alias("list"))


def _merged(roots: DataFrame | None, lists: DataFrame, threshold: float) -> DataFrame:
    """(node, root) once the new links of the lists have joined components; `roots` is what was known before."""
    links = lists.select("u", F.inline("list")).where(F.col("fresh") & (F.col("cos") >= threshold)).select("u", "v")
    if roots is None:
        return stored(components(links), "vector-roots")
    for end in ("u", "v"):
        owner = roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        links = links.join(owner, end, "left").withColumn(f"{end}_root", F.coalesce(f"{end}_root", end))
    across = checkpointed(links.where("u_root != v_root").select("u_root", "v_root").distinct())
    if across.isEmpty():
        return roots
    joined = components(across).withColumnRenamed("root", "to")
    moved = roots.join(joined.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    new = joined.select("node", F.col("to").alias("root")).join(roots.select("node"), "node", "left_anti")
    return stored(moved.union(new), "vector-roots")


def _round(lists: DataFrame, nodes: DataFrame, roots: DataFrame, k: int) -> DataFrame:
    edges = lists.select("u", F.inline("list"))
    owners = roots.select(F.col("node").alias("member"), "root")
    both = edges.select(F.col("u").alias("center"), F.col("v").alias("member"), "fresh").union(edges.select("v", "u", "fresh"))
    both = both.groupBy("center", "member").agg(F.max("fresh").alias("fresh"))
    both = both.join(owners, "member", "left").withColumn("root", F.coalesce("root", "member"))
    # neighbourhoods with something new, and with members of more than one component
    centers = both.groupBy("center").agg(F.count("*").alias("size"), F.max("fresh").alias("any"), F.min("root").alias("low"), F.max("root").alias("high"))
    centers = centers.where("any and low < high").select("center", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    floor = F.when(F.size("list") >= F.col("k"), F.element_at("list", -1)["cos"]).otherwise(-2.0)
    members = nodes.select(F.col("node").alias("member"), "vec").join(lists.select(F.col("u").alias("member"), floor.alias("floor"), "k"), "member")
    near = both.join(centers, "center").withColumn("part", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int"))
    near = near.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    near = near.withColumn("a", F.least("part", "other")).withColumn("b", F.greatest("part", "other")).join(members, "member")
    found = near.select("center", "a", "b", "part", "member", "root", "fresh", "floor", "k", "vec")
    found = found.repartition("center", "a", "b").sortWithinPartitions("center", "a", "b", "member")
    new = found.mapInArrow(_compared, "u long, v long, cos double").withColumn("fresh", F.lit(True))
    old = edges.select("u", "v", "cos", F.lit(False).alias("fresh"))
    return _lists(new.union(old), lists.select("u", "k"), k)


def neighbour_lists(nodes: DataFrame, first_seed: int, before: tuple[DataFrame, DataFrame] | None, k: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(lists, roots) by NN-descent from ORDERS random-projection orders (and what was found before) to rest."""
    seeds = list(range(first_seed, first_seed + ORDERS))
    pairs = _ordered_pairs(nodes, seeds, k).withColumn("fresh", F.lit(True))
    sizes = roots = None
    if before is not None:
        lists, roots = before
        pairs = pairs.union(lists.select("u", F.inline("list")).select("u", "v", "cos", F.lit(False)))
        sizes = lists.select("u", "k")
    lists = _lists(pairs, sizes, k)
    while True:
        lists = checkpointed(_enlarged(lists, threshold))
        fresh = F.exists("list", lambda e: e["fresh"])
        joins = F.exists("list", lambda e: e["fresh"] & (e["cos"] >= threshold))
        changed, linked = lists.agg(F.max(fresh), F.max(joins)).first()
        if linked or roots is None:
            roots = _merged(roots, lists, threshold)
        if not changed:
            return lists, roots
        lists = _round(lists, nodes, roots, k)


def _audit(nodes: DataFrame, lists: DataFrame, roots: DataFrame, threshold: float, sample: int) -> tuple[int, int]:
    """(links, links found) of audited nodes against all nodes of their labels.

    Audited are `sample` nodes whose list has a link or nearly one, and as many of all nodes: a fixed number, drawn by digest.
    """
    rows = nodes.join(roots, "node", "left").select("node", "label", F.coalesce("root", "node").alias("root"), "vec")
    close = lists.where(F.element_at("list", 1)["cos"] >= threshold - NEAR).select(F.col("u").alias("node"))
    drawn = [some.orderBy(F.xxhash64("node", F.lit(11)), "node").limit(sample) for some in (close, nodes.select("node"))]
    asked = rows.join(drawn[0].union(drawn[1]).distinct(), "node", "left_semi").toArrow().combine_chunks()
    if not asked.num_rows:
        return 0, 0
    parts = [(some, _matrix(some.column("vec"))) for batch in asked.to_batches() for some in _by_length(batch)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = found = 0
        for mixed in batches:
            for batch in _by_length(mixed):
                x = _matrix(batch.column("vec"))
                ids, labels, owners = (np.asarray(batch.column(c))[:, None] for c in ("node", "label", "root"))
                for some, vectors in parts:
                    if vectors.shape[1] == x.shape[1]:
                        node, label, root = (np.asarray(some.column(c)) for c in ("node", "label", "root"))
                        linked = (x @ vectors.T >= threshold) & (labels == label) & (ids != node)
                        links += int(linked.sum())
                        found += int((linked & (owners == root)).sum())
        yield pa.RecordBatch.from_arrays([pa.array([links]), pa.array([found])], ["links", "found"])

    total = rows.mapInArrow(count, "links long, found long").agg(F.sum("links"), F.sum("found")).first()
    return total[0] or 0, total[1] or 0


def _counted(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, counts, held = [], [], 0

        def done() -> pa.RecordBatch:
            n, c = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (nodes, counts))
            return pa.RecordBatch.from_arrays([pa.array(n), pa.array(c)], ["node", "links"])

        for rows in _groups(batches, ["root", "a", "b"]):
            x, copies, block = _matrix(_array(rows, "vec")), rows.column("copies").to_numpy(), rows.column("block").to_numpy()
            a, b = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
            cos = x @ x.T
            np.fill_diagonal(cos, -2)
            linked = cos >= threshold
            if a != b:  # only across; pairs within a block are counted in its own group
                linked &= block[:, None] != block[None, :]
            nodes.append(rows.column("node").to_numpy())
            counts.append(linked.astype(np.int64) @ copies)
            held += rows.num_rows
            if held > 50_000:
                yield done()
                nodes, counts, held = [], [], 0
        yield done()

    return run


def link_counts(nodes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(node, links): for nodes of components, the rows of other nodes at the threshold or above."""
    sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
    placed = roots.join(sizes, "root").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = placed.join(nodes.select("node", "copies", "vec"), "node")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other"))
    rows = rows.select("root", "a", "b", "block", "node", "copies", "vec").repartition("root", "a", "b").sortWithinPartitions("root", "a", "b", "node")
    return rows.mapInArrow(_counted(threshold), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", threshold: float = THRESHOLD, k: int = NEIGHBOURS, recall: float = RECALL) -> DataFrame:
    """id, n_links, component_id, kept of every row.

    Rows link if their labels are equal and not null, their vectors have the same length, and the cosine of these, in
    double precision, is at least the threshold. Vectors that are null, empty or zero, or hold null or non-finite
    components, link with nothing: no links, a component of their own, kept. Equal vectors of a label are links of
    each other like any other. Components are named by the smallest id reachable (a row without an id has its
    component, which may be null); kept is true where that is the row's own id. An empty table gives an empty result.
    Links are found by search; if audits go on seeing less than `recall` of them, that is an error.
    """
    kind = "array<float>" if vectors.schema[vector_column].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label_column).alias("kind"), F.col(vector_column).cast(kind).alias("vec"))
    # vectors of one label and one length belong together; digests stand for both
    rows = rows.withColumn("label", F.when(F.col("kind").isNotNull() & _valid(F.col("vec")), F.xxhash64("kind", F.size("vec")))).drop("kind")
    rows = rows.withColumn("node", F.when(F.col("label").isNotNull(), F.xxhash64("label", "vec")))
    grouped = rows.where("node is not null").groupBy("label", "node", "vec").agg(F.count("*").alias("copies"), F.min("id").alias("first"))
    nodes = stored(grouped, "vectors")
    found = None
    for attempt in range(AUDITS):
        found = lists, roots = neighbour_lists(nodes, 1000 * attempt, found, k, threshold)
        links, seen = _audit(nodes, lists, roots, threshold, AUDITED)
        if seen >= recall * links:
            break
    else:
        raise RuntimeError(f"{seen} of {links} audited links found after {AUDITS} times {ORDERS} orders; take a larger k")
    counts = link_counts(nodes, roots, threshold)
    named = nodes.select("node", "copies", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    found = named.join(least, "root").join(counts, "node", "left").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = rows.where("node is not null").select("id", "node").join(found, "node").select("id", "n_links", "component_id")
    alone = rows.where("node is null").select("id", F.lit(0).cast("long"), "id")
    return linked.union(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
