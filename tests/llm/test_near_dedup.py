import random
import weakref

import numpy as np
import pyarrow as pa

import corpus_pipeline
from punctual.llm import piece_codec, shingle_dedup, simhash


def shingle_set(text):
    words = [w.lower() for w in (text or "").split()]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def first_of_groups(rows):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if (5 * both >= 4 * len(sets[a] | sets[b])) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min(least.get(g, (True, 0)), (i is None, i or 0))
    return sorted(least.values())


def edited_copies(seed=12):
    """Copies with scattered edits around the similarity asked, beside texts that only share passages."""
    source = random.Random(seed)
    word = lambda: f"w{source.randrange(3000)}"
    rows = []
    for k in range(12):
        base = [word() for _ in range(source.randint(40, 300))]
        for _ in range(8):
            text = list(base)
            for _ in range(source.randint(0, len(base) // 30)):
                text[source.randrange(len(text))] = word()
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
        rows.append((2000 + k, " ".join([word() for _ in range(200)] + base[:60])))
    return rows


def test_near_dedup_stage_against_brute_force(spark, documents, odd_rows):
    rows = odd_rows + edited_copies()
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    prints = {i: simhash.fingerprint(t.encode()) for i, t in rows if i is not None and t}
    far = [1 for a in prints for b in prints if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and (prints[a] ^ prints[b]).bit_count() > 3]
    assert len(far) > 20
    got = corpus_pipeline.drop_near_duplicates(spark, documents(rows), "")
    assert tuple(got.columns) == corpus_pipeline.COLUMNS
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == first_of_groups(rows)


def test_order_of_shingles_changes_no_result(documents, monkeypatch):
    rows = edited_copies(13)
    expected = first_of_groups(rows)
    for common in (2, 1 << 30):
        monkeypatch.setattr(shingle_dedup, "COMMON", common)
        assert sorted((False, r.doc_id) for r in shingle_dedup.keep_first(documents(rows)).collect()) == expected


def test_simhash_brings_pairs_that_are_then_verified(spark, documents, monkeypatch):
    """The stage's named method: its pairs alone link near copies, and none that is less similar than asked."""
    base = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-1], "x"])), (3, " ".join(base[:200] + [f"v{k}" for k in range(200)]))]
    asked = []
    pairs = shingle_dedup.near_pairs
    monkeypatch.setattr(shingle_dedup, "near_pairs", lambda nodes, *a: asked.append(nodes.count()) or pairs(nodes, *a))
    # without shared shingles only SimHash is left
    monkeypatch.setattr(shingle_dedup, "_prefixes", lambda *a: shingle_dedup._each(lambda x: [x.view("int64")[:0], x.astype("int32")[:0], x.view("int64")[:0], x.astype("int32")[:0]], [], ["node", "n", "token", "pos"]))
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert asked


def test_candidates_less_similar_than_asked_go_before_their_shingles_are_compared():
    draw = np.random.default_rng(5)
    pair = lambda n, same, m: (common := draw.integers(0, 1 << 63, same, np.uint64), [np.unique(np.append(common, draw.integers(0, 1 << 63, k - same, np.uint64))) for k in (n, m)])[1]
    near = [pair(n, n - n // 20, m) for n in (1, 5, 12, 300, 2300) for m in (n, n + n // 12)]
    far = [pair(2300, 1930, 2300), pair(2000, 1750, 2200), pair(300, 245, 300)]
    assert all(9 * len(np.intersect1d(x, y)) >= 4 * (len(x) + len(y)) for x, y in near)
    assert all(9 * len(np.intersect1d(x, y)) < 4 * (len(x) + len(y)) for x, y in far)
    sides = [[shingle_dedup._named(found) for found in side] for side in zip(*near, *far, strict=True)]
    columns = {f"{a}{name}": [v[at][0] for v in side] for a, side in zip("xy", sides, strict=True) for name, at in (("", 0), ("n", 1), ("parts", 2))}
    batch = pa.RecordBatch.from_pydict({k: columns[k] for k in ("x", "y", "xn", "yn", "xparts", "yparts")})
    assert [b.column("x").to_pylist() for b in shingle_dedup._may_be_similar([batch])] == [columns["x"][: len(near)]]


def crowd(size, edits, variants=0, seed=3):
    """Copies of one text, which itself is not there, with words replaced; some have a variant passage, too."""
    source = random.Random(seed)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(size):
        text = list(base)
        if variants and i % 4 == 0:
            text[40:50] = [f"v{i % variants}x{k}" for k in range(10)]
        for at in source.sample(range(len(text)), source.choice(edits)):
            text[at] = f"e{source.randrange(10**9)}"
        rows.append((i, " ".join(text)))
    return rows


def test_near_copies_below_the_similarity_asked_do_not_bring_all_their_pairs(documents, monkeypatch):
    asked = []
    links = shingle_dedup._links
    monkeypatch.setattr(shingle_dedup, "_links", lambda pairs, *a: asked.append(pairs.count()) or links(pairs, *a))
    rows = crowd(300, [3])
    assert sorted((False, r.doc_id) for r in shingle_dedup.keep_first(documents(rows)).collect()) == first_of_groups(rows)
    # of 44,850 pairs those that share a rare difference
    assert sum(asked) < 44_850 / 5


def test_crowds_against_brute_force(documents, monkeypatch):
    rows = crowd(160, [0, 1, 2, 3, 5, 9], variants=3) + [(200 + i, t) for i, t in crowd(40, [1, 2, 3], seed=4)]
    other = [(1000 + i, "before it " + " ".join(f"u{k}" for k in range(60)) + " " + t) for i, t in crowd(100, [2, 3, 4], seed=5)]
    searched = []
    by_difference = shingle_dedup._by_difference
    monkeypatch.setattr(shingle_dedup, "_by_difference", lambda members, *a: searched.append(members.count()) or by_difference(members, *a))
    for least in (2, 64):
        monkeypatch.setattr(shingle_dedup, "CROWD", least)
        assert sorted((False, r.doc_id) for r in shingle_dedup.keep_first(documents(rows + other)).collect()) == first_of_groups(rows + other)
    assert min(searched) > 64


def test_texts_that_only_share_a_passage_are_no_crowd(documents, monkeypatch):
    """Their differences from a centre would be all their shingles, sent and put in order again."""
    source = random.Random(8)
    passage = [f"p{k}" for k in range(40)]
    words = lambda: [f"u{source.randrange(10**9)}" for _ in range(300)]
    rows = [(i, " ".join(words() + passage)) for i in range(150)]
    rows += [(200 + i, f"{t} end") for i, t in rows[:20]] + [(300 + i, t) for i, t in crowd(100, [2, 3, 4], seed=6)]
    searched = []
    by_difference = shingle_dedup._by_difference
    monkeypatch.setattr(shingle_dedup, "_by_difference", lambda members, *a: searched.append(members.count()) or by_difference(members, *a))
    # a passage of a corpus so large that the sample for the order hardly meets it
    monkeypatch.setattr(shingle_dedup, "COMMON", 1 << 30)
    assert sorted((False, r.doc_id) for r in shingle_dedup.keep_first(documents(rows)).collect()) == first_of_groups(rows)
    assert [64 <= n <= 100 for n in searched] == [True]


def test_passages_that_few_of_many_texts_share_bring_no_candidates(documents, monkeypatch):
    """The order knows them from all texts; a sample of a large corpus doesn't meet them often enough."""
    source = random.Random(9)
    words = lambda n: [f"u{source.randrange(10**9)}" for _ in range(n)]
    rows = []
    for _ in range(8):
        passage = words(90)
        rows += [(len(rows) + i, " ".join(words(100) + passage + words(100))) for i in range(30)]
    rows += [(1000 + i, f"{t} end") for i, t in rows[:20]]
    # before: texts of a sample
    monkeypatch.setattr(shingle_dedup, "SAMPLE", 20, raising=False)
    asked = []
    by_prefix = shingle_dedup._by_prefix
    monkeypatch.setattr(shingle_dedup, "_by_prefix", lambda *a: (pairs := by_prefix(*a), asked.append(pairs.count()))[0])
    assert sorted((False, r.doc_id) for r in shingle_dedup.keep_first(documents(rows)).collect()) == first_of_groups(rows)
    # of 3,480 pairs that share a passage, each by many shingles
    assert sum(asked) < 100


def test_frequencies_are_never_too_small(documents):
    texts = documents([(i, f"a b c d e f{i}") for i in range(40)] + [(99, None)]).selectExpr("coalesce(cast(text as binary), binary('')) text")
    steps = shingle_dedup._frequencies(texts.repartition(3))
    found = shingle_dedup.shingles(b"a b c d e f1", shingle_dedup._Names())
    at = lambda x: steps[int(x) & (len(steps) - 1)]
    assert sorted(at(x) for x in found) == [shingle_dedup._step(1), shingle_dedup._step(40)]
    assert shingle_dedup._step(16) < shingle_dedup._step(40)


def test_a_worker_lets_go_what_the_operator_before_kept():
    batch = pa.RecordBatch.from_pydict({"text": pa.array([b"one two three four five six"] * 3)})
    with_ids = pa.RecordBatch.from_pydict({"id": [1, 2, 3], "text": batch.column("text")})
    next(piece_codec._encode(piece_codec.model_path())([with_ids]))
    kept = weakref.ref(piece_codec._codec(piece_codec.model_path()))
    assert kept() is not None
    list(shingle_dedup._each(shingle_dedup._named, [], ["node", "n", "parts", "fp"])([batch]))
    assert kept() is None
