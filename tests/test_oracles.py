"""Every registered query against its SQL, on the smallest of the given sizes."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registered
from punctual.checks import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{os.path.join(small, table)}.parquet'")
    return connection


def comparable(rows):
    def plain(value):
        if isinstance(value, float) and math.isnan(value):
            return "nan"
        return float(value) if isinstance(value, int) and not isinstance(value, bool) else value

    return sorted((tuple(plain(v) for v in row) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_oracle_belongs_to_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert set(catalog.QUERIES) <= set(registered.queries())
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"feature_vectors", "model_comparison"}


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, small, oracle, name):
    got = registered.queries()[name](spark, small)
    plan = got._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in plan, node
    # documents are the one thing that Python takes apart, in Arrow batches
    assert ("MapInArrow" in plan) == (name in ("siri_explode", "archive_load"))
    cursor = oracle.execute(registered.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert comparable(got.select(*names).collect()) == comparable(cursor.fetchall())


@pytest.mark.parametrize("name", ["feature_vectors"])
def test_query_without_oracle(spark, small, name):
    assert registered.queries()[name](spark, small).count() > 0


def test_entry(spark, small):
    rows = registered.entry(spark).collect()
    assert len(rows) == 25 and 800 < sum(r.events for r in rows) < 1000
