import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from punctual.llm import embedding_dedup, recompression, simhash, suffix_dedup, windows
from punctual.llm.components import components


def planted(seed=3):
    """Texts of few words with shared passages, edits, periods and copies."""
    source = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "été", "zu") for b in ("n", "ra", "s", "tt")]
    text = lambda n: " ".join(source.choice(words) for _ in range(n))
    passages = [text(n) for n in (49, 50, 51, 70, 120)]
    rows = []
    for i in range(60):
        parts = [text(source.randint(0, 40)) for _ in range(3)]
        for passage in source.sample(passages, source.randint(0, 2)):
            edited = passage.split(" ")
            if source.random() < 0.3:
                edited[source.randrange(len(edited))] = "edit"
            parts.insert(source.randint(0, 3), " ".join(edited))
        rows.append((i * 3, source.choice([" ", "\n", "  "]).join(parts)))
    rows += [(500, "la " * 130), (501, "la " * 90 + "end"), (502, "aß" * 300), (503, rows[4][1]), (2, rows[4][1])]
    return rows


def covered(n, starts, size):
    gone = set()
    for s in starts:
        gone.update(range(s, s + size))
    return gone


def words_without_repeats(rows):
    order = lambda i: float("inf") if i is None else i
    split = [(order(i), (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, words in split:
        for k in range(len(words) - 49):
            window = tuple(words[k : k + 50])
            first[window] = min(first.get(window, i), i)
    out = []
    for i, words in split:
        gone = covered(len(words), [k for k in range(len(words) - 49) if first[tuple(words[k : k + 50])] < i], 50)
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def bytes_without_repeats(rows):
    texts = [(str(i), (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + 200] for _, t in texts for k in range(len(t) - 199))
    out = []
    for i, t in texts:
        gone = covered(len(t), [k for k in range(len(t) - 199) if seen[t[k : k + 200]] > 1], 200)
        spans = sum(k - 1 not in gone for k in gone)
        out.append((i, len(t), len(gone), spans, hashlib.sha256(bytes(b for k, b in enumerate(t) if k not in gone)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("together", [256, 1])
def test_word_windows_against_brute_force(documents, odd_rows, monkeypatch, together):
    monkeypatch.setattr(windows, "CLASSES_TOGETHER", together)
    rows = odd_rows + planted()
    got = recompression.repeat_digests(documents(rows)).collect()
    assert sorted(("inf" if r.id is None else str(r.id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == words_without_repeats(rows)


@pytest.mark.parametrize("together", [256, 1])
def test_byte_windows_against_brute_force(documents, odd_rows, monkeypatch, together):
    monkeypatch.setattr(windows, "CLASSES_TOGETHER", together)
    rows = [r for r in odd_rows if r[0] != 9] + planted(4)
    got = suffix_dedup.repeat_digests(documents(rows)).collect()
    assert sorted((str(r.id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == bytes_without_repeats(rows)


def test_cut_texts_keep_rows_and_columns(documents):
    frame = documents([(1, "é" * 150), (2, "x" + "é" * 150), (3, None)])
    cut = suffix_dedup.without_repeats(frame)
    assert cut.columns == frame.columns
    assert {r.doc_id: (r.text, r.key) for r in cut.collect()} == {1: ("", "en"), 2: ("x", "en"), 3: ("", "en")}


@pytest.mark.parametrize("operator", [recompression.repeat_digests, suffix_dedup.repeat_digests, recompression.without_repeats, suffix_dedup.without_repeats])
def test_nothing_of_nothing(documents, operator):
    assert operator(documents([])).count() == 0


def test_equal_windows_have_equal_anchors():
    source = random.Random(5)
    words = np.array([source.randrange(6) for _ in range(3000)], np.uint64)
    words[1000:1100] = words[2000:2100]
    anchor, names = recompression.Recompressor().scan(words, np.array([0, 700, 3000])).anchors()
    for k in range(51):
        assert anchor[1000 + k] - 1000 == anchor[2000 + k] - 2000
        assert names[1000 + k] == names[2000 + k]


def test_range_minimum():
    values = np.array([5, 3, 9, 1, 1, 7, 2, 8], np.uint64)
    for width in range(1, 10):
        assert windows.range_minimum(values, width).tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_components(spark):
    source = random.Random(8)
    pairs = [(source.randrange(400), source.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1300)] + [(5000, i) for i in range(5001, 5100)]
    pairs += [(7, None), (None, 8)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_link_like_brute_force(documents, odd_rows):
    source = random.Random(9)
    base = [source.choice("abcdefghij") * 3 for _ in range(60)]
    rows = list(odd_rows)
    for i in range(120):
        edited = list(base)
        for _ in range(source.randint(0, 2)):
            edited[source.randrange(60)] = "other"
        rows.append((200 + i, " ".join(edited)))
    prints = [(i, simhash.fingerprint((t or "").encode())) for i, t in rows]
    distinct = sorted({f for _, f in prints})
    group = {f: {f} for f in distinct}
    for a in distinct:
        for b in distinct:
            if (a ^ b).bit_count() <= 3 and group[a] is not group[b]:
                joined = group[a] | group[b]
                for f in joined:
                    group[f] = joined
    least = {f: min((i for i, g in prints if g in group[f] and i is not None), default=None) for f in distinct}
    got = simhash.near_duplicates(documents(rows)).collect()
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(((r.id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=key) == sorted(((i, f, least[f]) for i, f in prints), key=key)
    kept = simhash.keep_first(documents(rows))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({least[f] for _, f in prints} - {None})
    assert "fp" in kept.columns
    assert simhash.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("few", [1 << 24, 0])
def test_all_pairs_are_found_with_two_groups_or_three(spark, monkeypatch, few):
    monkeypatch.setattr(simhash, "FEW", few)
    source = random.Random(10)
    prints = {source.getrandbits(64) for _ in range(40)}
    for f in list(prints):
        for bits in range(1, 5):
            g = f
            for b in source.sample(range(64), bits):
                g ^= 1 << b
            prints.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    got = {(r.x, r.y) for r in simhash.near_pairs(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}


def test_thresholds_cost_least():
    holes = simhash.Pigeonholes([list(range(0, 22)), list(range(22, 43)), list(range(43, 64))])
    holes.sketch = [np.random.default_rng(i).integers(0, 500, 1 << simhash.SKETCH_BITS) for i in range(3)]
    fps = np.random.default_rng(1).integers(0, 1 << 63, 20).astype(np.uint64)
    values = holes.values(fps)
    costs = [holes.costs(values[g], g) for g in range(3)]
    options = [(a, b, 4 - a - b) for a in range(5) for b in range(5 - a)]
    chosen = holes.thresholds(values)
    assert (chosen.sum(axis=0) == 3 - 3 + 1).all()
    for row in range(20):
        best = min(sum(costs[g][o[g], row] for g in range(3)) for o in options)
        assert np.isclose(sum(costs[g][chosen[g, row] + 1, row] for g in range(3)), best)


def vectors(n=240, seed=4):
    random_ = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rows.append((i, random_.normal(size=16).tolist(), i % 3))
    for i in range(60):  # a dense clump, and chains
        rows.append((1000 + i, (np.array(rows[0][1]) + random_.normal(size=16) * 0.05).tolist(), 0))
    for i in range(20):
        rows.append((2000 + i, (np.array(rows[1][1]) + i * 0.12 * np.ones(16)).tolist(), 1))
    rows += [(3000, rows[0][1], 0), (3001, rows[0][1], 1), (3002, rows[0][1], None), (3002, rows[0][1], 0), (None, rows[0][1], 0)]
    rows += [(4000, None, 0), (4001, [0.0] * 16, 0), (4002, [float("nan")] * 16, 0), (4003, [1.0] * 15 + [None], 0), (4004, [], 0), (4005, [float("inf")] * 16, 0)]
    return rows


def test_links_and_components_of_vectors(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' as node", "1 as root")
    unit = []
    for _, v, label in rows:
        fine = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float32).astype(np.float64) if fine else None
        unit.append(x / np.linalg.norm(x) if fine else None)
    linked = defaultdict(set)
    for a, x in enumerate(unit):
        for b, y in enumerate(unit):
            if a != b and x is not None and y is not None and rows[a][2] == rows[b][2] and x @ y >= 0.98:
                linked[a].add(b)
    expected = []
    for a, (i, _, _) in enumerate(rows):
        reached, todo = {a}, [a]
        while todo:
            new = linked[todo.pop()] - reached
            reached |= new
            todo += new
        least = min((rows[b][0] for b in reached if rows[b][0] is not None), default=None)
        expected.append((i, len(linked[a]), least, i == least))
    got = [(r.id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame).collect()]
    order = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(got, key=order) == sorted(expected, key=order)


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_vectors_of_two_lengths_and_of_very_large_doubles(spark):
    rows = [(1, [1e300, 1e300], 0), (2, [1e300, 1e300], 0), (3, [1e-300, 1.01e-300], 0), (4, [1.0, 0.0, 0.0], 0), (5, [2.0, 0.0, 0.0], 0), (6, [0.0, 1.0, 0.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame).collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, 4, True), (5, 1, 4, False), (6, 0, 6, True)]


def large_label(n=5000, clump=700, seed=9):
    """One label: vectors far apart, a clump of more than PART members, and pairs around the threshold."""
    random_ = np.random.default_rng(seed)
    x = random_.normal(size=(n, 24))
    x[:clump] = x[0] + random_.normal(size=(clump, 24)) * 0.12
    for i in range(clump, n - 1, 8):
        x[i + 1] = x[i] + random_.normal(size=24) * 0.19
    return x.astype(np.float32)


def test_a_large_label_with_a_clump_and_pairs_near_the_threshold(spark):
    x = large_label()
    frame = spark.createDataFrame([(i, v.tolist(), 3) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.98
    np.fill_diagonal(linked, False)
    component, before = np.arange(len(x)), None
    while before is None or (component != before).any():
        before = component.copy()
        for a, b in zip(*np.nonzero(linked), strict=True):
            component[a] = component[b] = min(component[a], component[b])
    assert embedding_dedup.PART < linked[:700].any(axis=1).sum()
    got = {r.id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(frame).collect()}
    assert got == {i: (int(linked[i].sum()), int(component[i])) for i in range(len(x))}


def test_an_audit_that_falls_short_is_an_error(spark, monkeypatch):
    frame = spark.createDataFrame([(i, [1.0, i / 100], 0) for i in range(5)], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(embedding_dedup, "_audit", lambda *a: (10, 5))
    monkeypatch.setattr(embedding_dedup, "AUDITS", 2)
    with pytest.raises(RuntimeError, match="5 of 10"):
        embedding_dedup.near_duplicates(frame)
