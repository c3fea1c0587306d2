import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text, more) as a table with columns that the operators use inside, too."""

    def make(rows, lang="en", source="src1"):
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t in rows]
        frame = spark.createDataFrame(full, DOCUMENTS)
        for name in ("id", "key", "doc", "spans", "fp", "tokens"):
            frame = frame.withColumn(name, frame["lang"])
        return frame

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and blank texts, repeated rows, ties, a very long text."""
    passage = " ".join(f"word{i % 17}x{i}" for i in range(80))
    long = " ".join(f"w{i % 997} {i * i % 131}" for i in range(30_000))
    return [
        (1, "The quick brown fox. " * 3), (2, None), (3, ""), (4, " \n\t "), (5, passage), (6, "before " + passage + " after"),
        (6, "before " + passage + " after"), (None, passage), (None, None), (7, "ünïcode Straße 日本語 \U0001f642 é naïve"), (8, "a"),
        (9, long), (10, "x" * 700), (11, "it's <|endoftext|> they're\r\n'tis  ''  "), (12, passage.upper()), (5, passage),
    ]


@pytest.fixture(scope="session")
def tokenizers_here():
    return pytest.importorskip("public_tokenizers")
