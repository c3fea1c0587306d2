"""Operators that return the rows of a table give back all of its columns, whatever their names."""

import pytest
from pyspark.sql import functions as F

from punctual.llm import mixing, quality_rules, shingle_dedup, simhash

NAMES = ["_base", "_ratio", "_quality", "_key", "_domain", "_source", "_tokens", "_epoch", "__epoch", "key", "quality", "base", "epochs", "cut", "level0", "a.b"]


@pytest.fixture(scope="module")
def crowded(spark):
    text = "one two three four five six seven eight nine ten eleven twelve %d"
    rows = [(i, text.replace("o", chr(97 + i)) % i, "s1/x", *(f"{n} of {i}" for n in NAMES)) for i in range(6)]
    columns = ", ".join(f"`{n}` string" for n in ["text", "source", *NAMES])
    return spark.createDataFrame([*rows, (6, *rows[0][1:3], *(f"{n} of 6" for n in NAMES))], f"doc_id long, {columns}")


def unchanged(frame, crowded):
    assert frame.columns[: len(crowded.columns)] == crowded.columns
    for r in frame.collect():
        assert list(r[3 : 3 + len(NAMES)]) == [f"{n} of {r.doc_id}" for n in NAMES]
    return sorted(r.doc_id for r in frame.collect())


def test_rules_keep_all_columns(spark, crowded):
    trusted = spark.createDataFrame([], "doc_id long")
    assert unchanged(quality_rules.passed(crowded, trusted), crowded) == list(range(7))


@pytest.mark.parametrize("operator", [shingle_dedup, simhash])
def test_near_dedup_keeps_all_columns(crowded, operator):
    found = unchanged(operator.keep_first(crowded), crowded)
    assert 0 in found and 6 not in found


def test_mixing_keeps_all_columns(crowded):
    levels = {"domain": F.split("source", "/")[0], "source": F.col("source")}
    taken = mixing.mixed(crowded, "doc_id", mixing.word_count(F.col("text")), 2.0, levels, ({}, {}), 2)
    assert taken.columns[len(crowded.columns) :] == ["__domain", "__source", "___epoch", "__tokens"]
    assert unchanged(taken, crowded) == sorted([*range(7)] * 2)
    assert {(r["__domain"], r["___epoch"]) for r in taken.collect()} == {("s1", 1), ("s1", 2)}
