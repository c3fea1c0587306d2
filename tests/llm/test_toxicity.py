import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from punctual.llm import toxicity as tox
from punctual.llm.toxicity import FEATURES, SECOND_PERSON, STAND_INS

INSULTS = ["zorgul", "vrakk", "plimwit"]


def corpus(n=900, seed=4):
    """Invented prose; a third are insults, some of them spelt with other signs, near a second person, or loud."""
    source = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "lo", "mi", "tes", "qua", "ner") for b in ("do", "rim", "sal", "ento", "ka", "vil")]
    rows, labels = [], []
    for i in range(n):
        text = [source.choice(words) for _ in range(source.randint(4, 60))]
        toxic = i % 3 == 0
        for _ in range(source.randint(1, 4) if toxic else 0):
            insult = source.choice(INSULTS)
            insult = source.choice([insult, insult, insult + "s", insult.upper() + "!", insult.replace("o", "0").replace("i", "1")])
            at = source.randrange(len(text))
            text[at:at] = ["you", insult] if source.random() < 0.5 else [insult]
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learnt(spark, documents):
    rows, labels = corpus()
    labels = spark.createDataFrame(labels + [(5, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    docs = documents(rows)
    return docs, labels, dict(rows), tox.fit(docs, labels)


def test_lexicon_against_brute_force(learnt):
    docs, labels, texts, model = learnt
    known = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id in texts and r.toxic is not None}
    digest = {r.doc_id: r.d for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(3)).alias("d")).collect()}
    learn = [i for i in known if zlib.crc32(str(i).encode()) % 5 and digest[i] % 4]
    sets = {}
    for i in learn:
        words = {re.sub(r"^[\W_]+|[\W_]+$", "", w).lower() for w in texts[i].split()} - {""}
        sets[i] = words | {w[:k] + "-" for w in words for k in (3, 4, 5, 6) if len(w) > k}
    n = [sum(known[i] == y for i in learn) for y in (0, 1)]
    expected = {}
    for term in set().union(*sets.values()):
        count = [sum(term in sets[i] for i in learn if known[i] == y) for y in (0, 1)]
        weight = math.log((count[1] + 0.5) / (n[1] + 1)) - math.log((count[0] + 0.5) / (n[0] + 1))
        if count[1] >= 3 and weight >= math.log(3):
            expected[term] = round(weight, 6)
    assert "zorgul" in model.lexicon and model.lexicon == pytest.approx(expected, abs=2e-6)


def features_by_hand(text, lexicon):
    def weight(word):
        return max([0.0, *(lexicon.get(t, 0.0) for t in [word, *(word[:k] + "-" for k in (3, 4, 5, 6) if len(word) > k)])])

    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    n, seen = max(len(words), 1), []
    for w in words:
        core = re.sub(r"^[\W_]+|[\W_]+$", "", w)
        clear = re.sub(r"[\W\d_]+", "", re.sub(r"^[\W_]+|[\W_]+$", "", w.lower().rstrip(".,;:!?")).translate(STAND_INS))
        clear = re.sub(r"(\w)\1\1+", r"\1", clear)
        hidden = weight(clear) if clear != core.lower() else 0
        seen.append((core, weight(core.lower()), hidden, max(weight(core.lower()), hidden)))
    is_term = [s[3] >= math.log(3) for s in seen]
    you = [i for i, s in enumerate(seen) if s[0].lower() in SECOND_PERSON]
    gaps = [min([50, *(abs(i - j) for j in you)]) for i, t in enumerate(is_term) if t]
    size, data = max(len(text.encode()), 1), text.encode()
    strong = sum(s[3] >= math.log(12) for s in seen)
    letters = [c for c in seen if sum(x.isalpha() for x in c[0]) > 1]
    return [
        math.log1p(len(words)), strong / n, math.log1p(strong), sum(is_term) / n, max([0.0, *(s[3] for s in seen)]),
        sum(s[3] for s, t in zip(seen, is_term, strict=True) if t) / n, sum(g <= 3 for g in gaps) / n, min([50, *gaps]), len(you) / n,
        len(re.findall("[A-Z]", text)) / max(len(re.findall("[A-Za-z]", text)), 1), sum(len(s[0]) > 1 and s[0].isupper() for s in seen) / n,
        text.count("!") / size, text.count("?") / size, sum(33 <= b < 127 and not chr(b).isalnum() for b in data) / size, sum(48 <= b < 58 for b in data) / size,
        sum(sum(x.isalpha() for x in s[0]) < len(s[0]) for s in letters) / n, sum(s[2] >= math.log(3) and s[2] > s[1] for s in seen) / n,
        sum(re.search(r"(\w)\1\1", s[0].lower()) is not None for s in seen) / n, len(data) / n,
    ]


def test_features_against_brute_force(learnt):
    model = learnt[3]
    texts = [t for _, t in corpus(60, 9)[0]]
    texts += ["", " \n ", "You... ZORGUL!!", "z0rgul vr@kk you", "zzzorgul-plimw1t", "«plimwit» tú", "Straße ÉTÉ 12 3a4 $$$", "zorguuuul x", "a! b? you \x1f zorgul", "éé" * 40]
    got = tox.Featurizer(model.lexicon)(pa.array([t.encode() for t in texts], pa.binary()))
    for text, row in zip(texts, got, strict=True):
        # words that Python's split of bytes sees: blanks of ASCII only
        expected = features_by_hand(text, model.lexicon)
        assert dict(zip(FEATURES, row, strict=True)) == pytest.approx(dict(zip(FEATURES, expected, strict=True)), abs=1e-5), text


def test_held_out_rows_are_found(learnt):
    docs, labels, _, model = learnt
    assert model.trees is not None and model.calibration is not None
    rows = tox.scored(docs, model).where("held_out").join(labels.withColumnRenamed("doc_id", "id").where("toxic is not null"), "id").collect()
    assert len(rows) > 100 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)
    assert {r.held_out for r in tox.scored(docs, model).collect()} == {True, False}
    for r in tox.scored(docs, model).collect():
        assert r.held_out == (zlib.crc32(str(r.id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5)


def test_calibration_keeps_the_order_of_the_trees(spark, learnt):
    docs, _, _, model = learnt
    bare = tox.scored(docs, tox.Model(model.lexicon, model.share, model.trees)).select("id", F.col("score").alias("raw"))
    both = sorted((r.raw, r.score) for r in tox.scored(docs, model).join(bare, "id").collect())
    assert (np.diff([s for _, s in both]) >= -1e-12).all()


def test_nothing_is_learnt_from_held_out_rows(learnt):
    docs, labels, _, model = learnt
    turned = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = tox.fit(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), turned)
    assert again.lexicon == model.lexicon
    scores = [{r.id: r.score for r in tox.scored(docs, m).collect()} for m in (model, again)]
    assert scores[0] == scores[1]


def test_odd_rows(learnt, documents, odd_rows):
    clashing = documents(odd_rows)
    for name in ("x", "p", "score", "label", "weight", "prediction", "rawPrediction", "held_out"):
        clashing = clashing.withColumn(name, F.lit("q"))
    got = tox.scored(clashing, learnt[3])
    assert got.columns == ["id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert sorted(str(r.id) for r in rows) == sorted(str(i) for i, _ in odd_rows)
    assert all(0 <= r.score <= 1 for r in rows) and not any(r.held_out for r in rows if r.id is None)
    assert len({r.score for r in rows if r.id in (2, 3)}) == 1
    assert tox.scored(documents([]), learnt[3]).count() == 0


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(i, 0) for i in range(50)], 0.0), ([(i, 1) for i in range(50)], 1.0), ([(i, None) for i in range(50)], 0.0)])
def test_labels_of_one_kind(spark, documents, labels, score):
    docs = documents(corpus(50)[0])
    model = tox.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r.score for r in tox.scored(docs, model).collect()} == {score}


def test_few_labels_and_no_documents(spark, documents):
    rows, labels = corpus(40)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = tox.fit(documents(rows), frame, toxic=3, clean=2)
    assert tox.scored(documents(rows), model).count() == 40
    assert {r.score for r in tox.scored(documents(rows), tox.fit(documents([]), frame)).collect()} != set()
