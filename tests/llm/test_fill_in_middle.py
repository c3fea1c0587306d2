import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from punctual.llm import fill_in_middle as fim


def by_hand(doc_id, text, rate=90, suffix_first=20, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def same(got, rows, **more):
    order = lambda r: tuple((x is None, str(x)) for x in r)
    found = sorted((tuple(r[c] for c in ("id", "n", "form", "prefix_chars", "middle_chars", "output")) for r in got), key=order)
    assert found == sorted((by_hand(i, t, **more) for i, t in rows), key=order)


def odd_texts():
    source = random.Random(8)
    signs = "ab <>PSM\néł€日\U0001f642́\U0010ffff"
    rows = [(1000 + i, "".join(source.choice(signs) for _ in range(source.randint(0, 40)))) for i in range(600)]
    return rows + [(5, "a<P>b"), (6, "<S>"), (7, "<M"), (8, "<" * 9), (9, "\U0001f642" * 50), (10, "<P" * 20)]


def test_against_slices_of_text(spark, documents, odd_rows):
    rows = odd_rows + odd_texts()
    got = fim.fill_in_middle(documents(rows))
    assert got.columns == ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    same(got.collect(), rows)


def test_other_rates(spark, documents):
    rows = odd_texts()
    same(fim.fill_in_middle(documents(rows), rate=100, suffix_first=100, seed=7).collect(), rows, rate=100, suffix_first=100, seed=7)
    assert {r.form for r in fim.fill_in_middle(documents(rows), rate=0).collect()} == {"plain"}


def test_every_text_comes_back(spark, documents, odd_rows):
    rows = odd_rows + odd_texts()
    got = fim.fill_in_middle(documents(rows), rate=100, suffix_first=50).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(((r.id, r.back) for r in got.collect()), key=key) == sorted(((i, t or "") for i, t in rows), key=key)


def test_empty_table(documents):
    assert fim.fill_in_middle(documents([])).count() == 0


def test_ids_of_text(spark):
    got = fim.fill_in_middle(spark.createDataFrame([("x1", "some text")], "doc_id string, text string")).collect()
    same(got, [("x1", "some text")])


def test_bytes_that_are_no_utf8(spark):
    raw = spark.sql("select id, cast(unhex(x) as string) text from values (1L, '80BF41'), (2L, 'C3'), (3L, 'FFFE80'), (4L, '41F09F') as v(id, x)")
    got = fim.fill_in_middle(raw, "id", rate=100).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    assert {r.id: bytes(r.b) for r in got.select("id", F.col("back").cast("binary").alias("b")).collect()} == {
        1: b"\x80\xbfA", 2: b"\xc3", 3: b"\xff\xfe\x80", 4: b"A\xf0\x9f"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=6))
def test_cuts_in_bytes_and_back(texts):
    packed = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, packed)])
    index = fim.Exceptions(np.frombuffer(b"".join(packed), np.uint8), bounds)
    begin = index.chars_before(bounds)
    assert np.diff(begin).tolist() == [len(t) for t in texts]
    for t, first, char in zip(texts, bounds, begin, strict=False):
        ends = np.array([first + len(t[:i].encode()) for i in range(len(t) + 1)])
        assert index.bytes_before(char + np.arange(len(t) + 1)).tolist() == ends.tolist()
        assert (index.chars_before(ends) - char).tolist() == list(range(len(t) + 1))
