"""Operator 2: a factorisation machine that scores the quality of a text.

Features: hashed words (each with 1 + log of its count, scaled to length one), statistics of the text's structure
and its stored length, each as one bin of a fixed scale. The score is the logistic of
  w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2),
so all pairs of features interact and one pass over them is enough. It is fitted on a bounded sample of labelled
rows (SAMPLE) and applied where the texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import PieceCache, joined_bytes, slices, sums_by_row, table, text_bytes

SAMPLE = 6000  # labelled rows to fit on, at most; those with the least digest of their id
WORD_BUCKETS = 1 << 15
FACTORS = 6
BINS = 24
EPOCHS = 12
BATCH = 200
RATE = 0.05
DECAY = 1e-4
CUT = 0.3
CACHED = 60_000  # words of a cache generation; a worker has two of them
STATISTICS = (
    "n_words", "stored_length", "word_length", "signs", "capitals", "digits", "stops", "line_length", "distinct",
    "again", "most_common", "lines_again", "beyond_ascii",
)
FEATURES = WORD_BUCKETS + len(STATISTICS) * BINS
_WORKER: dict = {}


def _char_classes() -> np.ndarray:
    """One row of flags per kind of byte."""
    kinds = np.zeros((6, 256), np.uint8)
    kinds[0, list(b"#*$%&|<>@^~_=+\\{}[]")] = 1
    kinds[1, 65:91] = 1
    kinds[2, 48:58] = 1
    kinds[3, list(b".,;:!?")] = 1
    kinds[4, 10] = 1
    kinds[5, 128:] = 1
    return kinds


class Featurizer:
    """Texts to sparse rows: bounds, feature numbers and values."""

    def __init__(self):
        from xxhash import xxh32_intdigest

        self.cache = PieceCache(lambda words: np.array([xxh32_intdigest(w) % WORD_BUCKETS for w in words], np.int32)[:, None], limit=CACHED)
        self.kinds = _char_classes()

    def __call__(self, column: pa.Array, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        texts = column.to_pylist()
        split = [t.split() for t in texts]
        rows, n = len(texts), np.array([len(s) for s in split], np.int64)
        buckets, _ = self.cache.expand(self.cache.places([w for s in split for w in s]))
        row = np.repeat(np.arange(rows), n)
        pair, count = np.unique(row * WORD_BUCKETS + buckets, return_counts=True)
        word_row, word = pair // WORD_BUCKETS, pair % WORD_BUCKETS
        value = 1 + np.log(count)
        kinds = np.bincount(word_row, minlength=rows)
        norm = np.sqrt(np.bincount(word_row, weights=value * value, minlength=rows))
        value = value / norm[word_row]
        data, bounds = joined_bytes(column)
        size = np.diff(bounds)
        signs, capitals, digits, stops, lines, wide = (sums_by_row(k[data].astype(np.int64), size) for k in self.kinds)
        again = np.bincount(row[1:][(buckets[1:] == buckets[:-1]) & (row[1:] == row[:-1])], minlength=rows)
        most = np.zeros(rows, np.int64)
        np.maximum.at(most, word_row, count)
        split_lines = [[line for line in t.split(b"\n") if line.strip()] for t in texts]
        lines_again = np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in split_lines])
        some, words = np.maximum(size, 1), np.maximum(n, 1)
        share = lambda a, b: np.minimum(a / b, 1) ** 0.5 * (BINS - 1)  # noqa: E731  finer where small
        long = lambda a: np.log1p(a) * 1.8
        bins = [
            long(n), long(np.maximum(stored, 0)), size / words, share(signs, some), share(capitals, some), share(digits, some), share(stops, some),
            long(n / (lines + 1)), share(kinds, words), share(again, words), share(most, words), lines_again**0.5 * (BINS - 1), share(wide, some),
        ]
        binned = np.stack([np.clip(b.astype(np.int64), 0, BINS - 1) + WORD_BUCKETS + i * BINS for i, b in enumerate(bins)], axis=1)
        total = kinds + len(STATISTICS)
        starts = np.concatenate([[0], np.cumsum(total)])
        index, x = np.empty(starts[-1], np.int64), np.empty(starts[-1])
        at = starts[word_row] + np.arange(len(word_row)) - np.concatenate([[0], np.cumsum(kinds)])[word_row]
        index[at], x[at] = word, value
        tail = (starts[1:, None] - len(STATISTICS) + np.arange(len(STATISTICS))).ravel()
        index[tail], x[tail] = binned.ravel(), len(STATISTICS) ** -0.5
        return starts, index, x


class FactorisationMachine:
    def __init__(self, seed: int = 3):
        random = np.random.default_rng(seed)
        self.bias = 0.0
        self.linear = np.zeros(FEATURES)
        self.factors = random.normal(0, 0.05, (FACTORS, FEATURES))

    def _sums(self, starts: np.ndarray, index: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The raw score of each row, and the sums of its factors; no row is without features."""
        add = lambda values: np.add.reduceat(values, starts[:-1])
        out = self.bias + add(self.linear[index] * x)
        sums = np.empty((FACTORS, len(starts) - 1))
        for f, v in enumerate(self.factors):
            vx = v[index] * x
            sums[f] = add(vx)
            out = out + 0.5 * (sums[f] ** 2 - add(vx * vx))
        return out, sums

    def score(self, starts: np.ndarray, index: np.ndarray, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._sums(starts, index, x)[0], -40, 40)))

    def fit(self, starts: np.ndarray, index: np.ndarray, x: np.ndarray, y: np.ndarray, seed: int = 5) -> FactorisationMachine:
        """Gradient steps scaled by the sums of squared gradients, over the rows in an order drawn from the seed."""
        random = np.random.default_rng(seed)
        squares, factor_squares, bias_square = np.full(FEATURES, 1e-6), np.full((FACTORS, FEATURES), 1e-6), 1e-6
        for _ in range(EPOCHS):
            order = random.permutation(len(y))
            for first in range(0, len(order), BATCH):
                rows = order[first : first + BATCH]
                length = starts[rows + 1] - starts[rows]
                bounds = np.concatenate([[0], np.cumsum(length)])
                at = np.repeat(starts[rows] - bounds[:-1], length) + np.arange(bounds[-1])
                i, v = index[at], x[at]
                raw, sums = self._sums(bounds, i, v)
                error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - y[rows]) / len(rows)
                each = np.repeat(error, length) * v
                used = np.unique(i)
                place = np.searchsorted(used, i)
                total = lambda g: np.bincount(place, weights=g, minlength=len(used))  # noqa: B023, E731
                grad = total(each) + DECAY * self.linear[used]
                squares[used] += grad**2
                self.linear[used] -= RATE * 4 * grad / np.sqrt(squares[used])
                for f in range(FACTORS):
                    own = self.factors[f]
                    grad = total(each * (np.repeat(sums[f], length) - own[i] * v)) + DECAY * own[used]
                    factor_squares[f, used] += grad**2
                    own[used] -= RATE * grad / np.sqrt(factor_squares[f, used])
                bias_square += error.sum() ** 2
                self.bias -= RATE * error.sum() / bias_square**0.5
        return self


def _featurizer() -> Featurizer:
    if "features" not in _WORKER:
        _WORKER["features"] = Featurizer()
    return _WORKER["features"]


def _stored_length(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("length").to_numpy(zero_copy_only=False).astype(np.float64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        starts, index, x = _featurizer()(batch.column("text"), _stored_length(batch))
        bounds = pa.array(starts.astype(np.int32))
        lists = [pa.ListArray.from_arrays(bounds, pa.array(a)) for a in (index.astype(np.int32), x.astype(np.float32))]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *lists], ["id", "label", "index", "x"])


def _rows(docs: DataFrame, id_column: str, text_column: str, length_column: str | None) -> DataFrame:
    length = F.coalesce(F.col(length_column).cast("long"), F.lit(0)) if length_column else F.lit(0).cast("long")
    return docs.select(F.col(id_column).alias("id"), length.alias("length"), text_bytes(text_column).alias("text"))


def held_out(id_: F.Column) -> F.Column:
    """Rows that are never learnt from: a fifth, by the crc32 of the id as text."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", length_column: str | None = "n_chars", label_column: str = "quality", sample: int = SAMPLE) -> FactorisationMachine:
    """Fits on up to `sample` labelled documents that are not held out.

    Labels that are null are left out; of several labels of an id the least counts; ids without a document
    teach nothing. The sample's ids are few by that bound, so they are broadcast and the texts stay where they
    are; what comes to the driver is their features.
    """
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull() & ~held_out(F.col(id_column)))
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.min(label_column).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = _rows(docs, id_column, text_column, length_column).join(F.broadcast(chosen), "id").dropDuplicates(["id"])
    kind = docs.schema[id_column].dataType.simpleString()
    found = rows.mapInArrow(_features, f"id {kind}, label int, index array<int>, x array<float>").toArrow()
    model = FactorisationMachine()
    if not found.num_rows:
        return model
    found = found.take(pa.compute.sort_indices(found, [("id", "ascending")])).combine_chunks()
    index, x = (found.column(c).chunk(0) for c in ("index", "x"))
    starts = np.asarray(index.offsets).astype(np.int64)
    return model.fit(starts - starts[0], index.flatten().to_numpy().astype(np.int64), x.flatten().to_numpy().astype(np.float64), found.column("label").to_numpy().astype(np.float64))


def _score(model: FactorisationMachine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = model.score(*_featurizer()(batch.column("text"), _stored_length(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], ["id", "score"])

    return run


def scored(docs: DataFrame, model: FactorisationMachine, id_column: str = "doc_id", text_column: str = "text", length_column: str | None = "n_chars", cut: float = CUT) -> DataFrame:
    """id, held_out, score (0 to 1) and predicted of every row, read and scored in place.

    A null text is empty; empty texts are scored by their structure; a null length counts as 0. Null ids are not
    held out; repeated rows give a row each; further columns are left out; an empty table gives an empty
    result. A model that has seen no label gives scores near one half.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    found = _rows(docs, id_column, text_column, length_column).mapInArrow(_score(model), f"id {kind}, score double")
    return found.select("id", held_out(F.col("id")).alias("held_out"), "score", F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).withColumnRenamed("id", "doc_id")
