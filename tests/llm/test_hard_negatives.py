import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def by_hand(rows, is_anchor, positives=5, negatives=10, window=(30, 90)):
    used = {}
    for i, vec, label in rows:
        if None in (i, vec, label) or any(x is None or not math.isfinite(x) for x in vec):
            continue
        whole = tuple(math.floor(256 * x) for x in vec)
        if all(abs(x) < 1 << 27 for x in whole):
            used[(i, label, whole)] = None
    out = []
    for i, label, vec in used:
        if not is_anchor(i):
            continue
        dot = lambda other: sum(a * b for a, b in zip(vec, other))  # noqa: E731, B023, B905
        score = sorted({(-dot(w), j, same == label) for j, same, w in used if j != i})
        for p, j in [(-s, j) for s, j, same in score if same][:positives]:
            fits = [(-s, k) for s, k, same in score if not same and window[0] * p <= -100 * s <= window[1] * p][:negatives]
            out += [(i, j, rank, k, p, s) for rank, (s, k) in enumerate(fits, 1)]
    return sorted(out)


def found(spark, rows, is_anchor=lambda i: i % 10 == 0, **more):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("leaf", F.lit(-1)).withColumn("vec", F.lit(0)).withColumn("ask", F.lit(""))
    got = hn.hard_negatives(frame, F.col("vec_id") % 10 == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect()), by_hand(rows, is_anchor, **{k: v for k, v in more.items() if k not in ("sample", "leaf")})


def clusters(n, size=6, seed=2):
    """Unit vectors around a few centres; labels follow them loosely, and some vectors are equal."""
    random_ = np.random.default_rng(seed)
    centres = random_.normal(size=(8, size))
    out = []
    for i in range(n):
        c = int(random_.integers(8))
        v = centres[c] + random_.normal(size=size) * 0.25
        v = centres[c] if i % 9 == 0 else v
        out.append((i, [float(x) for x in v / np.linalg.norm(v)], int((c + (random_.random() < 0.3)) % 4)))
    return out


def test_clusters_against_all_pairs(spark):
    got, expected = found(spark, clusters(900), leaf=20)
    assert len(expected) > 2000 and got == expected


def test_small_sample_indexes_every_row(spark):
    got, expected = found(spark, clusters(600, seed=3), sample=60, leaf=1)
    assert got == expected


def test_blocks_of_rows_and_queries(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 50)
    monkeypatch.setattr(hn, "ASKED", 7)
    monkeypatch.setattr(hn, "TOGETHER", 3)
    # a third of all rows has one vector
    rows = clusters(400, seed=4) + [(5000 + i, [0.6, 0.8, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(200)]
    got, expected = found(spark, rows, leaf=10**6)
    assert got == expected
    got, expected = found(spark, rows, leaf=10, positives=2, negatives=3, window=(50, 100))
    assert got == expected


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clusters(60, size=3, seed=5)
    rows += [(100, None, 1), (110, [1.0, None, 0.0], 1), (120, [nan, 0.0, 1.0], 1), (130, [inf, 0.0, 0.0], 1), (140, [0.1, 0.2, 0.3], None), (None, [0.1, 0.2, 0.3], 1)]
    rows += [(150, [], 1), (151, [], 2), (160, [0.0, 0.0, 0.0], 1), (170, [1e300, 0.0, 0.0], 1), (180, [-1.0, -1.0, -1.0], 3), (181, [-1.0], 2)]
    rows += rows[:15] + [(0, [0.5, 0.5, 0.5], 1), (10, rows[10][1], 3), (200, [70000.5, -3.25, 8.0], 2), (201, [70000.5, 1.0, 1.0], 2), (202, [30000.0, 0.0, 0.0], 1)]
    padded = [(i, v if v is None else v + [0.0] * (3 - len(v)), label) for i, v, label in rows]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in hn.hard_negatives(frame, F.col("vec_id") % 10 == 0, leaf=8).collect())
    assert got == by_hand(padded, lambda i: i % 10 == 0)


def test_scores_beyond_doubles(spark):
    rows = [(10, [300000.0, 100000.001], 1), (1, [300000.0, 100000.002], 1), (2, [299999.0, 1.0], 2), (3, [299999.0, 0.999], 2), (4, [200000.0, 3.0], 2)]
    got, expected = found(spark, rows)
    assert expected and got == expected


@pytest.mark.parametrize("rows", [[], [(10, [0.1, 0.2], 1)], [(10, [0.1], 1), (11, [0.1], 1)], [(None, None, None)]])
def test_nothing_to_find(spark, rows):
    assert found(spark, rows) == ([], [])


def test_bounds_hold_for_every_row():
    random_ = random.Random(3)
    x = np.array([[random_.randint(-300, 300) for _ in range(5)] for _ in range(700)])
    tree = hn.Tree(x[:200], 12)
    rows = []
    assert tree.leaves > 10
    ranges = {}

    def see(node, d, near, at):
        for row, j in enumerate(near):
            norm = float((x[at[row]] ** 2).sum())
            for i in range(d.shape[1]):
                a, b, c, e = ranges.get((node.number, j, i), (np.inf, -np.inf, np.inf, -np.inf))
                ranges[(node.number, j, i)] = min(a, d[row, i]), max(b, d[row, i]), min(c, norm), max(e, norm)

    leaf = tree.leaf_of(x, see)
    tree.set_ranges([(*k, *v) for k, v in ranges.items()])
    least, most = tree.bounds(x)
    scores = x @ x.T
    assert (least[:, leaf] <= scores).all() and (scores <= most[:, leaf]).all()
    near = np.array([[300] * 5])
    rows = tree.bounds(near)[1][0]
    assert (rows < (near @ x.T).max()).any()  # some leaves can be left out
