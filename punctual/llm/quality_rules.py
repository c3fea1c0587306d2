"""Operator 4: quality rules, base counts and a likelihood ratio of hashed n-grams, in built-in functions only.

Two multinomials over a fixed number of hash buckets are counted: single tokens and pairs of neighbours in the
trusted documents, and in all documents. A document's score is the mean over its n-grams of the log of the ratio
of the two smoothed probabilities. The weights are whole numbers (2^-20 nats), so a sum is the same in any order
and every verdict is reproducible.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import restored, set_aside, table

BUCKETS = 4096
UNIT = 1 << 20
MIN_RATIO = -0.25
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words
REPEAT_WORDS = 5
BLANKS = r"[\x20\x09-\x0D]+"
TOKENS = r"(\p{L}+|\p{N}+|[^\p{L}\p{N}\s]+)"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKENS), F.lit(1))


def _repeated_words(words: Column, n: Column) -> Column:
    """Words in windows of five that occur twice or more in the text, each word once."""
    last = n - REPEAT_WORDS
    # windows by a 64-bit name: two of one text that differ share it about once in 10^19 pairs
    names = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[words[i + k] for k in range(REPEAT_WORDS)]))

    def covered(places: Column) -> Column:
        gap = lambda p, j: F.least(F.lit(REPEAT_WORDS), F.coalesce(F.get(places, j + 1) - p, F.lit(REPEAT_WORDS)))
        return F.aggregate(F.transform(places, gap), F.lit(0), lambda a, x: a + x)

    def places(by_name: Column) -> Column:
        same = lambda s, j: F.get(by_name, j)["h"].eqNullSafe(s["h"])
        both = F.filter(by_name, lambda s, j: same(s, j - 1) | same(s, j + 1))
        return F.array_sort(F.transform(both, lambda s: s["i"]))

    def found(h: Column) -> Column:
        by_name = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        some = F.size(F.array_distinct(h)) < F.size(h)
        return F.when(some, _let(_let(by_name, places), covered)).otherwise(0)

    return F.when(last > 0, _let(names, found)).otherwise(0)


def base_counts(text: Column) -> Column:
    """A struct of the base counts of a text that is not null."""
    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>]"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    repeated_lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))

    def counts(words: Column) -> Column:
        n = F.size(words)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            repeated_lines.cast("long").alias("n_dup_lines"),
            _repeated_words(words, n).cast("long").alias("n_repeat_words"),
        )

    return _let(words_of(text), counts)


def _bucket(*tokens: Column) -> Column:
    return F.pmod(F.xxhash64(*tokens), F.lit(BUCKETS)).cast("int")


def ngram_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n) over all n-grams of the column text; partial sums hold no more than BUCKETS rows a task."""

    def grams(t: Column) -> Column:
        pairs = F.when(F.size(t) > 1, F.transform(F.sequence(F.lit(0), F.size(t) - 2), lambda i: _bucket(t[i], t[i + 1])))
        return F.concat(F.transform(t, lambda x: _bucket(x)), F.coalesce(pairs, F.array().cast("array<int>")))

    return texts.select(F.explode(_let(tokens_of(F.col("text")), grams)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def log_ratios(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> list[int]:
    """The weight of each bucket: BUCKETS whole numbers. trusted holds ids; with none of them here all weights are 0."""
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ids = trusted.select(F.col(trusted.columns[0]).alias("id")).distinct()
    raw = ngram_counts(texts)
    target = ngram_counts(texts.join(ids.hint("shuffle_hash"), "id", "left_semi"))
    both = raw.select("bucket", F.col("n").alias("r"), F.lit(0).cast("long").alias("t")).union(target.select("bucket", F.lit(0).cast("long"), "n"))
    counted = both.groupBy("bucket").agg(F.sum("r").alias("r"), F.sum("t").alias("t")).collect()  # BUCKETS rows at most
    raw_all, target_all = sum(row.r for row in counted), sum(row.t for row in counted)
    if not target_all:
        return [0] * BUCKETS
    seen = {row.bucket: (row.r, row.t) for row in counted}

    def weight(r: int, t: int) -> int:
        return round(UNIT * (log((t + 1) / (target_all + BUCKETS)) - log((r + 1) / (raw_all + BUCKETS))))

    return [weight(*seen.get(bucket, (0, 0))) for bucket in range(BUCKETS)]


def _mean_ratio(tokens: Column, weights: Column) -> Column:
    """Sum of the weights of all n-grams over their number; 0 without any."""

    def total(t: Column) -> Column:
        def one(i: Column) -> Column:
            pair = F.coalesce(F.when(i + 1 < F.size(t), weights[_bucket(t[i], F.get(t, i + 1))]), F.lit(0).cast("long"))
            return weights[_bucket(t[i])] + pair

        summed = F.aggregate(F.sequence(F.lit(0), F.size(t) - 1), F.lit(0).cast("long"), lambda a, i: a + one(i))
        return F.when(F.size(t) > 0, summed / (2 * F.size(t) - 1)).otherwise(F.lit(0.0))

    return _let(tokens, total)


def judged(docs: DataFrame, weights: list[int], text_column: str = "text", min_ratio: float = MIN_RATIO) -> DataFrame:
    """The columns of docs, set aside, and the struct `quality`: base counts, base_failed, kept and log_ratio (nats)."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    table_ = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")
    counted = docs.select(*set_aside(docs), base_counts(text).alias("base"), _mean_ratio(tokens_of(text), table_).alias("ratio"))
    b = lambda name: F.col("base")[name]
    failed = (b("n_words") < MIN_WORDS) | (100 * b("n_repeat_words") > MAX_REPEATED * b("n_words"))
    kept = ~failed & (F.col("ratio") >= min_ratio * UNIT)
    quality = F.struct(*[b(c).alias(c) for c in BASE], failed.alias("base_failed"), kept.alias("kept"), (F.col("ratio") / UNIT).alias("log_ratio"))
    return counted.withColumn("quality", quality).drop("base", "ratio")


def quality_rules(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_ratio: float = MIN_RATIO) -> DataFrame:
    """id, the base counts, base_failed, kept and log_ratio of every row of docs.

    trusted: one column of ids of documents that the target multinomial is made of; ids without a document and
    repeated ids change nothing; if no trusted document has a token, only the base rules judge. A null text is
    empty: no words, so base_failed. Null ids and repeated rows give a row each and count in the raw
    multinomial; further columns are left out; an empty table gives an empty result.
    """
    weights = log_ratios(docs, trusted, id_column, text_column)
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return judged(slim, weights, "text", min_ratio).select(F.col("column0").alias("id"), "quality.*")


def passed(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_ratio: float = MIN_RATIO) -> DataFrame:
    """The rows of docs that the rules keep, unchanged."""
    weights = log_ratios(docs, trusted, id_column, text_column)
    return judged(docs, weights, text_column, min_ratio).where("quality.kept").select(*restored(docs))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that labels mark as good and not toxic."""
    return table(spark, sf_dir, "labels").where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir)).withColumnRenamed("id", "doc_id")
