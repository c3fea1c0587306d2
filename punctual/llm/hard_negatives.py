"""Operator 11: hard negatives by a GNAT-style tree of hyperplane splits.

Vectors are whole numbers (each component scaled and floored), so scores are exact. A node of the tree has a few
split points far from each other, and a vector goes to the nearest: the borders are hyperplanes. The split points
come from a bounded sample; all rows are then sent down. Each split point keeps, for every sibling subtree, the
range of distances from it to the rows there, worked out over all rows.

A search asks for the best scores in a window. With the norms of a subtree's rows the window is an annulus of
distances around the query. From the distance to a split point and its range for a sibling, the triangle
inequality bounds the distances from the query to that sibling's rows; if they miss the annulus, the sibling goes.
What is left are leaves, which are compared exactly: first the few most promising ones of each query, which gives a
score to beat, then all others that may still reach it. So results are exact whatever the sample was.

Leaves with many rows are cut into blocks, and so are the queries of a leaf; a task holds one block of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.llm.common import checkpointed, stored, table

SCALE = 256
LARGEST = 1 << 27  # components beyond it could make a score that is no long
SAMPLE = 16_384  # rows that the split points are drawn from, at most
DEGREE = 8  # split points of a node
LEAF = 1024  # rows a leaf should hold, if the sample allows
ROWS = 16_384  # rows of a leaf in one block
ASKED = 1024  # queries of a leaf in one block
TOGETHER = 64  # queries that are multiplied at once
FIRST = 3  # leaves that each window of a query sees first
LOWEST, HIGHEST = -(1 << 62), 1 << 62
FOUND = "ask long, w int, score long, id long"


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = np.asarray(column.flatten())
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows with all rows, exactly: in doubles as long as these hold every sum."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(np.float64), b.astype(np.float64)
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


class Node:
    """Split points, and for each either a node below or the number of a leaf."""

    def __init__(self, number: int, points: np.ndarray, below: list):
        self.number, self.points, self.below = number, points, below


class Tree:
    """Built from a sample; `ranges` come from all rows."""

    def __init__(self, sample: np.ndarray, leaf: int, degree: int = DEGREE):
        self.nodes: list[Node] = []
        self.leaves = 0
        self.degree = degree
        self.width = sample.shape[1]
        self.root = self._grow(sample, max(leaf, 1))
        self.low = self.high = self.norms = None

    def _grow(self, rows: np.ndarray, leaf: int):
        if len(rows) > leaf:
            points = self._split_points(rows)
            if len(points) > 1:
                node = Node(len(self.nodes), points, [])
                self.nodes.append(node)
                near = distances(rows, points).argmin(axis=1)
                node.below = [self._grow(rows[near == j], leaf) for j in range(len(points))]
                return node
        self.leaves += 1
        return self.leaves - 1

    def _split_points(self, rows: np.ndarray) -> np.ndarray:
        """Greedily, each as far from the others as can be, among some rows at even steps."""
        some = rows[:: max(1, len(rows) // (20 * self.degree))]
        chosen = [int(distances(some, some.mean(axis=0, keepdims=True))[:, 0].argmax())]
        far = distances(some, some[chosen])[:, 0]
        while len(chosen) < self.degree and not (some == some[chosen[-1]]).all():
            at = int(far.argmax())
            if (some[chosen] == some[at]).all(axis=1).any():
                break
            chosen.append(at)
            far = np.minimum(far, distances(some, some[[at]])[:, 0])
        return some[chosen]

    def leaf_of(self, x: np.ndarray, see: Callable | None = None) -> np.ndarray:
        """The leaf of each row. `see` is told of every step: node, the rows' distances and where they go."""
        out = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not isinstance(node, Node):
                out[rows] = node
                continue
            d = distances(x[rows], node.points)
            near = d.argmin(axis=1)
            if see is not None:
                see(node, d, near, rows)
            todo += [(below, rows[near == j]) for j, below in enumerate(node.below)]
        return out

    def set_ranges(self, found: list[tuple]) -> None:
        """Rows of (node, child, point, low, high, least norm, greatest norm), one of each; others are empty subtrees."""
        shape = (len(self.nodes), self.degree, self.degree)
        self.low, self.high = np.full(shape, np.inf), np.full(shape, -np.inf)
        self.norms = np.full((*shape[:2], 2), np.nan)
        # distances are rounded: a little room on both sides keeps every bound true
        for node, child, point, low, high, short, long in found:
            self.low[node, child, point], self.high[node, child, point] = low * (1 - 1e-9) - 1e-3, high * (1 + 1e-9) + 1e-3
            self.norms[node, child] = short * (1 - 1e-9), long * (1 + 1e-9)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For queries x leaves: the least and the greatest score that a row of the leaf can have with the query."""
        least, most = np.full((len(x), self.leaves), -np.inf), np.full((len(x), self.leaves), np.inf)
        square = (x.astype(np.float64) ** 2).sum(axis=1)
        todo = [(self.root, np.full(len(x), -np.inf), np.full(len(x), np.inf))]
        while todo:
            node, low, high = todo.pop()
            if not isinstance(node, Node):
                least[:, node], most[:, node] = low, high
                continue
            d = distances(x, node.points)
            for j, below in enumerate(node.below):
                k = d.shape[1]
                to_low, to_high = self.low[node.number, j, :k], self.high[node.number, j, :k]
                if np.isnan(self.norms[node.number, j, 0]):
                    todo.append((below, np.full(len(x), np.inf), np.full(len(x), -np.inf)))
                    continue
                nearest = np.maximum(np.maximum(d - to_high, to_low - d).max(axis=1), 0)
                farthest = (d + to_high).min(axis=1)
                short, long = self.norms[node.number, j]
                # score = (|q|^2 + |x|^2 - distance^2) / 2, and no more than |q| |x|
                room = 1e-9 * (square + long) + 1e-3
                upper = np.minimum((square + long - nearest**2) / 2, np.sqrt(square * long)) + room
                lower = (square + short - farthest**2) / 2 - room
                todo.append((below, np.maximum(low, lower), np.minimum(high, upper)))
        return least, most


def whole_numbers(vectors: DataFrame, anchors: F.Column, id_column: str, vector_column: str, label_column: str, scale: int = SCALE) -> DataFrame:
    """id, label, vec (whole numbers) and anchor of the rows that take part, repeated ones once."""
    fine = lambda x: F.coalesce(~F.isnan(x) & (F.abs(F.floor(scale * x)) < LARGEST), F.lit(False))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vec"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("vec", fine), F.lit(False))
    return rows.where(usable).withColumn("vec", F.transform("vec", lambda x: F.floor(scale * x).cast("int"))).distinct()


def _leaves(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaf_of(matrix(batch.column("vec"), tree.width))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], [*batch.schema.names, "leaf"])

    return run


def _ranges(tree: Tree):
    """One row for each range that a task has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (len(tree.nodes), tree.degree, tree.degree)
        low, high = np.full(shape, np.inf), np.full(shape, -np.inf)
        short, long = np.full(shape[:2], np.inf), np.full(shape[:2], -np.inf)
        for batch in batches:
            x = matrix(batch.column("vec"), tree.width)
            norm = (x.astype(np.float64) ** 2).sum(axis=1)

            def see(node, d, near, rows, norm=norm):
                for j in np.unique(near):
                    mine = near == j
                    k = d.shape[1]
                    low[node.number, j, :k] = np.minimum(low[node.number, j, :k], d[mine].min(axis=0))
                    high[node.number, j, :k] = np.maximum(high[node.number, j, :k], d[mine].max(axis=0))
                    short[node.number, j] = min(short[node.number, j], norm[rows[mine]].min())
                    long[node.number, j] = max(long[node.number, j], norm[rows[mine]].max())

            tree.leaf_of(x, see)
        node, child, point = np.nonzero(high >= 0)
        columns = [node, child, point, low[node, child, point], high[node, child, point], short[node, child], long[node, child]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "child", "point", "low", "high", "short", "long"])

    return run


def index(rows: DataFrame, sample: int = SAMPLE, leaf: int = LEAF) -> tuple[DataFrame, Tree]:
    """The rows (id, label, vec, anchor) with their leaf, as a stored table, and the tree.

    The tree is fitted on up to `sample` rows, those with the least digests, which come to the driver; every row
    is indexed. Ranges come back merged: their number is bounded by the nodes of the tree.
    """
    rows = checkpointed(rows)
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("width")).first()
    drawn = rows.orderBy(F.xxhash64("vec", "id"), "id").limit(sample).select("vec").toArrow().column("vec")
    points = matrix(drawn, size.width)
    tree = Tree(points, max(2 * DEGREE, leaf * len(points) // max(size.n, 1)))
    kept = stored(rows.mapInArrow(_leaves(tree), "id long, label long, vec array<int>, anchor boolean, leaf int"), "gnat-rows")
    seen = kept.select("vec").mapInArrow(_ranges(tree), "node long, child long, point long, low double, high double, short double, long double")
    merged = seen.groupBy("node", "child", "point").agg(F.min("low"), F.max("high"), F.min("short"), F.max("long"))
    # norms of a subtree are the same for all its points
    tree.set_ranges([tuple(r) for r in merged.collect()])
    return kept, tree


def _visits(tree: Tree, first: bool):
    """Queries to the leaves they must see: the first few of each window, or all others that may hold a result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                least, most = tree.bounds(matrix(batch.column("vec"), tree.width))
                windows = batch.column("windows")
                owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(windows.offsets)))
                flat = windows.flatten()
                low, high, floor = (np.asarray(flat.field(c)).astype(np.float64) for c in ("low", "high", "floor"))
                reach = np.minimum(most[owner], high[:, None])
                possible = (reach >= low[:, None]) & (least[owner] <= high[:, None]) & (least[owner] <= most[owner])
                # the leaves of the first round are those again in the second, as nothing about them has changed
                best = np.argsort(np.where(possible, -reach, np.inf), axis=1, kind="stable")[:, :FIRST]
                early = np.zeros_like(possible)
                np.put_along_axis(early, best, True, axis=1)
                early &= possible
                seen = np.zeros((batch.num_rows, tree.leaves), bool)
                np.logical_or.at(seen, owner, early)
                if not first:
                    rest = np.zeros_like(seen)
                    np.logical_or.at(rest, owner, possible & (reach >= floor[:, None]))
                    seen = rest & ~seen
                ask, leaf = np.nonzero(seen)
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(ask)).columns, pa.array(leaf.astype(np.int32))], [*batch.schema.names, "leaf"])

    return run


def _compare(width: int, k: int, same: bool):
    """A block of a leaf's rows against a block of its queries: the k best (score, id) of each window."""

    def run(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and asks.num_rows:
            rows = rows.sort_by("id")
            x, ids, labels = matrix(rows.column("vec"), width), rows.column("id").to_numpy(), rows.column("label").to_numpy()
            for start in range(0, asks.num_rows, TOGETHER):
                some = asks.slice(start, TOGETHER)
                scores = products(matrix(some.column("vec"), width), x)
                for ask, own, label, windows, score in zip(*(some.column(c).to_pylist() for c in ("ask", "own", "label", "windows")), scores, strict=True):
                    fits = ((labels == label) == same) & (ids != own)
                    fits &= (score >= min(max(w["low"], w["floor"]) for w in windows)) & (score <= max(w["high"] for w in windows))
                    at = np.flatnonzero(fits)
                    at = at[np.argsort(-score[at], kind="stable")]  # equal scores: in the order of ids
                    mine, best = ids[at], score[at]
                    new = np.ones(len(at), bool)
                    new[1:] = (mine[1:] != mine[:-1]) | (best[1:] != best[:-1])
                    mine, best = mine[new], best[new]
                    for w in windows:
                        first = np.searchsorted(-best, -w["high"])
                        stop = min(first + k, np.searchsorted(-best, -max(w["low"], w["floor"]), side="right"))
                        if first < stop:
                            out.append((np.full(stop - first, ask), np.full(stop - first, w["w"], np.int32), best[first:stop], mine[first:stop]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        return pa.table(columns, names=["ask", "w", "score", "id"])

    return run


def _seen(rows: DataFrame, tree: Tree, asks: DataFrame, k: int, same: bool, first: bool) -> DataFrame:
    """(ask, w, score, id) from the leaves of one round, the k best of each block and more than needed in all."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asks.schema.fields)
    visits = checkpointed(asks.mapInArrow(_visits(tree, first), f"{kinds}, leaf int"))
    blocks = rows.groupBy("leaf").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("blocks"))
    parts = visits.groupBy("leaf").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("parts"))
    grid = F.broadcast(blocks.join(parts, "leaf"))  # one row a leaf, of which the sample allows some thousand
    block = lambda count, *key: F.pmod(F.xxhash64(*key), F.col(count)).cast("int")
    left = rows.join(grid, "leaf").withColumn("block", block("blocks", "id", "vec")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = visits.join(grid, "leaf").withColumn("part", block("parts", "ask")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    by = ("leaf", "block", "part")
    left, right = left.select(*by, "id", "label", "vec"), right.select(*by, *asks.columns)
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_compare(tree.width, k, same), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each window, with their rank. Spark keeps k of each before the exchange, too."""
    order = Window.partitionBy("ask", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k).dropDuplicates(["ask", "w", "rank"])


def search(rows: DataFrame, tree: Tree, asks: DataFrame, k: int, same: bool) -> DataFrame:
    """(ask, w, score, id, rank): for each query and window the k best rows whose label is the query's, or is not.

    asks: ask (its number), own (the id that is left out), label, vec, windows (array of w, low, high), all in
    whole numbers. Best is the highest score in the window, ends included; ties go to the smaller id.
    """
    asks = asks.withColumn("windows", F.transform("windows", lambda w: w.withField("floor", F.lit(LOWEST))))
    early = checkpointed(_best(_seen(rows, tree, asks, k, same, True), k))
    # a window that has k results needs only what is at least as good as the last of them
    full = early.where(F.col("rank") == k).groupBy("ask").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("full"))
    raised = asks.join(full, "ask", "left").withColumn(
        "windows", F.transform("windows", lambda w: w.withField("floor", F.coalesce(F.try_element_at("full", w["w"]), F.lit(LOWEST))))
    )
    late = _seen(rows, tree, raised.drop("full"), k, same, False)
    return _best(early.drop("rank").union(late), k)


def hard_negatives(
    vectors: DataFrame, anchors: F.Column, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), sample: int = SAMPLE, leaf: int = LEAF,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of two vectors whose components are floor(256 x). Anchors are the rows where the
    column `anchors` holds (an expression over any columns of the table). An anchor's positives are its best rows of the same label, without those of its own
    id; for each of them, its negatives are the best rows of other labels whose score is between window[0] and
    window[1] hundredths of the positive's. Ties go to the smaller id; what is fewer is returned as it is.

    Rows with a null id, label, vector or component take no part, nor do those with a component that is not
    finite or, scaled, beyond 2^27. Ids and labels are whole numbers. A shorter vector counts as one that ends in zeros. Repeated rows count once; rows that
    share an id but no vector are rows, and anchors, of their own, unless a query has the same score with both. Further columns are left out; an empty table gives an empty result.
    """
    rows, tree = index(whole_numbers(vectors, anchors, id_column, vector_column, label_column), sample, leaf)
    asks = rows.where("anchor").withColumn("ask", F.xxhash64("id", "label", "vec")).select("ask", F.col("id").alias("own"), "label", "vec")
    asks = checkpointed(asks)
    whole = F.array(F.struct(F.lit(0).alias("w"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high")))
    near = checkpointed(search(rows, tree, asks.withColumn("windows", whole), positives, True))
    low, high = window
    # the ends of the window in whole scores: low/100 of the positive's, rounded up, to high/100, rounded down
    ends = F.struct(
        F.col("rank").alias("w"), (-F.expr(f"(-{low} * score - pmod(-{low} * score, 100)) div 100")).alias("low"),
        F.expr(f"({high} * score - pmod({high} * score, 100)) div 100").alias("high"),
    )
    windows = near.groupBy("ask").agg(F.collect_list(ends).alias("windows"))  # at most `positives` of them
    far = search(rows, tree, asks.join(windows, "ask"), negatives, False)
    far = far.select("ask", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = near.select("ask", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = far.join(near, ["ask", "w"]).join(asks.select("ask", F.col("own").alias("anchor_id")), "ask")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLE = """
with used as (
  select vec_id id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) vec
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.id anchor_id, r.id, a.label = r.label same, cast(list_inner_product(a.vec, r.vec) as bigint) score
  from used a, used r where a.id % 100 = 0 and a.id <> r.id
), positives as (
  select anchor_id, id positive_id, score positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
), negatives as (
  select anchor_id, positive_id, id negative_id, positive_score, score negative_score,
    row_number() over (partition by anchor_id, positive_id order by score desc, id) rank
  from positives join scored using (anchor_id)
  where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
)
select anchor_id, positive_id, cast(rank as integer) rank, negative_id, positive_score, negative_score from negatives where rank <= 10"""
