import random
import re
from collections import Counter, defaultdict
from math import log

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.llm import mixing, quality_classifier, quality_rules


def base_counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    repeated = {k for found in places.values() if len(found) > 1 for i in found for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def rows_of_kinds():
    source = random.Random(6)
    word = lambda: source.choice(["ab", "cde", "fg", "hij", "été"])
    rows = [(i, " ".join(word() for _ in range(30))) for i in range(40)]
    rows += [(100 + i, " ".join(word().upper() + "!!" for _ in range(30))) for i in range(15)]
    rows += [(200, "a b c d e " * 6), (201, "one two\none two\n\n \none two\r\n"), (202, "x " * 9), (203, "x y z " * 3), (204, "p q r s t u v w x y z p q r s t end of it all")]
    return rows


def test_base_counts_against_brute_force(spark, documents, odd_rows):
    rows = odd_rows + rows_of_kinds()
    trusted = spark.createDataFrame([(i,) for i in range(20)], "doc_id long")
    got = quality_rules.quality_rules(documents(rows), trusted).collect()
    found = Counter((r.id, *(r[c] for c in quality_rules.BASE), r.base_failed) for r in got)
    expected = Counter()
    for i, t in rows:
        counts = base_counts(t or "")
        expected[(i, *counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0])] += 1
    assert found == expected
    assert not any(r.kept for r in got if r.base_failed)


def test_ratio_against_brute_force(spark, documents):
    xxhash = pytest.importorskip("xxhash")
    rows = [(i, t) for i, t in rows_of_kinds()]
    trusted = set(range(20))

    def java(x):
        return x - (1 << 64) if x >> 63 else x

    def grams(text):
        tokens = re.findall(r"[^\W\d_]+|\d+|[^\w\s]+", text)
        one = lambda t, seed: xxhash.xxh64_intdigest(t.encode(), seed)
        return [java(one(t, 42)) % 4096 for t in tokens] + [java(one(b, one(a, 42))) % 4096 for a, b in zip(tokens, tokens[1:])]  # noqa: B905

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in trusted:
            target.update(grams(t))
    weight = [round(2**20 * (log((target[b] + 1) / (target.total() + 4096)) - log((raw[b] + 1) / (raw.total() + 4096)))) for b in range(4096)]
    frame = documents(rows)
    got = quality_rules.quality_rules(frame, spark.createDataFrame([(i,) for i in trusted] + [(0,), (None,), (99999,)], "doc_id long")).collect()
    for r in got:
        each = [weight[b] for b in grams(dict(rows)[r.id])]
        assert r.log_ratio == pytest.approx(sum(each) / len(each) / 2**20, abs=1e-9)
        assert r.kept == (not r.base_failed and sum(each) / len(each) >= -0.25 * 2**20)
    kept = {r.doc_id for r in quality_rules.passed(frame, spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()}
    repetitive = {r.id for r in got if r.base_failed}
    assert set(range(40)) - repetitive <= kept and not kept & set(range(100, 115))


def test_rules_without_trusted_rows_or_any(spark, documents):
    none = spark.createDataFrame([], "doc_id long")
    assert all(r.kept != r.base_failed for r in quality_rules.quality_rules(documents(rows_of_kinds()), none).collect())
    assert quality_rules.quality_rules(documents([]), none).count() == 0


def test_rules_stay_in_the_engine(spark, documents):
    plan = quality_rules.quality_rules(documents(rows_of_kinds()), spark.createDataFrame([(1,)], "doc_id long"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sum_of_squares_is_the_sum_over_pairs():
    model = quality_classifier.FactorisationMachine()
    model.linear[:] = np.random.default_rng(1).normal(size=len(model.linear))
    index, x = np.array([3, 70, 500, 9, 70]), np.array([0.5, -1.0, 2.0, 1.0, 0.25])
    starts = np.array([0, 3, 5])
    raw, _ = model._sums(starts, index, x)
    for row in range(2):
        i, v = index[starts[row] : starts[row + 1]], x[starts[row] : starts[row + 1]]
        pairs = sum(model.factors[:, i[a]] @ model.factors[:, i[b]] * v[a] * v[b] for a in range(len(i)) for b in range(a))
        assert raw[row] == pytest.approx(model.bias + model.linear[i] @ v + pairs)


def test_classifier_learns_and_never_from_held_out_rows(spark, documents):
    rows = [(i, t) for k in range(6) for i, t in ((1000 * k + i, t + f" w{k}") for i, t in rows_of_kinds()[:55])]
    frame = documents(rows)
    labels = frame.select("doc_id", F.when(F.col("doc_id") % 1000 < 100, 1).otherwise(0).alias("quality"))
    turned = labels.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    extra = spark.createDataFrame([(1, None), (None, 1), (77777, 0)], "doc_id long, quality int")
    scores = {}
    for name, known in (("plain", labels), ("turned", turned.union(extra))):
        model = quality_classifier.fit(frame, known)
        scores[name] = {r.id: r for r in quality_classifier.scored(frame, model).collect()}
    assert all(r.score == scores["turned"][i].score for i, r in scores["plain"].items())
    held = [r for r in scores["plain"].values() if r.held_out]
    assert len(held) > 30 and all(r.predicted == (r.id % 1000 < 100) for r in held)


def test_scores_of_odd_rows(spark, documents, odd_rows):
    frame = documents(odd_rows)
    model = quality_classifier.fit(frame, spark.createDataFrame([], "doc_id long, quality int"))
    got = quality_classifier.scored(frame, model).collect()
    assert Counter(r.id for r in got) == Counter(i for i, _ in odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality_classifier.scored(documents([]), model).count() == 0


def leaf_rows(spark):
    source = random.Random(2)
    rows = []
    for i in range(400):
        lang = source.choice(["en", "en", "de", "fr", None])
        rows.append((i if i != 50 else None, "w " * source.randint(0, 40), lang, source.choice(["src0", "src0", "src1", "src2", "src7", "blog", None])))
    rows += [(7, "again and again", "en", "src0")] * 3 + [(8, None, "en", "src0"), (900, "", "es", "empty")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("epoch", F.lit("x"))


def test_mixture_equals_its_sql(spark, tmp_path):
    frame = leaf_rows(spark)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.query(spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    expected = connection.execute(f"select {', '.join(got.columns)} from ({mixing.oracle()})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(expected)


def test_budget_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10), ("a", "x", "2", 100), ("a", "y", "3", 100), ("b", "x", "1", 5), ("b", "z", "9", 5)], "domain string, lang string, source string, tokens long")
    plain = ({}, {}, {})
    got = {(r.domain, r.lang, r.source): r.quota for r in mixing.budgets(leaves, 100, weights=plain, max_epochs=1).collect()}
    # b holds 10 of its 50, the rest goes to a; in a, x and y share alike; source 1 holds 10 of x's 45, source 2 takes the rest
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 35, ("a", "y", "3"): 45, ("b", "x", "1"): 5, ("b", "z", "9"): 5}
    assert {r.quota for r in mixing.budgets(leaves, 10**6, weights=plain, max_epochs=2).collect() if r.source == "9"} == {10}
    none = {r.quota for r in mixing.budgets(leaves, 100, weights=({"b": 0}, {}, {}), max_epochs=1).collect() if r.domain == "b"}
    assert none == {0}


def test_epochs_and_prefixes(spark):
    frame = leaf_rows(spark)
    levels = {"source": F.col("source")}
    taken = mixing.mixed(frame, "doc_id", mixing.word_count(F.col("text")), 1.5, levels, ({},), 3).collect()
    again = mixing.mixed(frame.repartition(7), "doc_id", mixing.word_count(F.col("text")), 1.5, levels, ({},), 3).collect()
    assert Counter((r.doc_id, r._epoch) for r in taken) == Counter((r.doc_id, r._epoch) for r in again)
    assert {r.epoch for r in taken} == {"x"}
    total = sum(len((r.text or "").split()) for r in frame.collect())
    assert 0 <= int(total * 1.5) - sum(r._tokens for r in taken) < 7 * 41


def test_nothing_to_mix(spark):
    empty = leaf_rows(spark).limit(0)
    assert mixing.mixed(empty, "doc_id", mixing.word_count(F.col("text")), 1.0, {"source": F.col("source")}, ({},)).count() == 0
    blank = leaf_rows(spark).withColumn("text", F.lit(" "))
    assert mixing.mixed(blank, "doc_id", mixing.word_count(F.col("text")), 1.0, {"source": F.col("source")}, ({},)).count() == 0
