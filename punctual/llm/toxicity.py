"""Operator 12: gradient-boosted trees over a few dense features of a text, calibrated by isotonic regression.

A lexicon is learnt first: words and beginnings of words that toxic texts have far more often than others. Features
are its densities (as met, and after signs and digits that stand for letters are undone), how near its words are to
words for the second person, and rates of capitals, punctuation and obfuscation. The trees are Spark's; so is the
isotonic regression, fitted on rows that neither lexicon nor trees have seen. All of it is learnt from a bounded
sample of labelled rows (TOXIC, CLEAN) and applied to every whole text where it is read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import PieceCache, joined_bytes, slices, stored, sums_by_row, table, text_bytes

TOXIC, CLEAN = 2500, 5000  # labelled rows of each kind to learn from, at most: those with the least digests
LEXICON = 4000  # terms, at most
BEGINNINGS = (3, 4, 5, 6)  # letters of a word that are terms, too
LEAST_TEXTS = 3  # toxic texts with a term
MEDIUM, STRONG = math.log(3), math.log(12)  # log odds of a term
NEAR = 3  # words between a term and the second person
CUT = 0.5
TREES, DEPTH, STEP, SEED = 40, 3, 0.15, 7
CALIBRATION = 4  # one of so many sampled rows calibrates, the others grow trees
CACHED = 60_000  # words whose properties a worker keeps
TERMS_HELD = 150_000  # counted in a task before they go out
# Words for the second person in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deiner euch euer ihr usted ustedes tú ti tus vosotros os".split()
)
# Signs that stand for letters.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "+": "t"})
FEATURES = (
    "words", "strong", "strong_count", "medium", "highest", "weight", "near_you", "distance_to_you", "you", "capitals", "capital_words",
    "exclamations", "questions", "signs", "digits", "obfuscated", "undone", "stretched", "word_length",
)
ASCII_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
NO_LETTER = re.compile(r"[\W\d_]+")
THRICE = re.compile(r"(\w)\1\1+")
_WORKER: dict = {}


def terms(word: str) -> list[str]:
    """What of a word the lexicon can know: all of it, and how it begins."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


def plain(word: str) -> str:
    """A word without the signs at its ends, in lower case."""
    return EDGE.sub("", word).lower()


def undone(word: str) -> str:
    """A word with letters for the signs that stand for them, none between letters, and none more than twice."""
    return THRICE.sub(r"\1", NO_LETTER.sub("", EDGE.sub("", word.lower().rstrip(".,;:!?")).translate(STAND_INS)))


class Featurizer:
    """Texts to rows of FEATURES, by a lexicon of terms and their weights."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.starts = {t[: BEGINNINGS[0]] for t in lexicon}
        self.cache = PieceCache(lambda words: [self.properties(w) for w in words], limit=CACHED, dtype=np.float32)

    def _weight(self, word: str) -> float:
        if word[: BEGINNINGS[0]] not in self.starts:
            return 0.0
        return max(self.lexicon.get(t, 0.0) for t in terms(word))

    def properties(self, raw: bytes) -> tuple[float, ...]:
        text = raw.decode("utf-8", "replace")
        core = text.strip(ASCII_SIGNS)
        if not core.isalpha():
            core = EDGE.sub("", text)
        word = core.lower()
        weight = self._weight(word)
        if core.isalpha():
            mixed = False
            thrice = len(word) - len(set(word)) > 1 and THRICE.search(word) is not None
            # nothing is to be undone but thrice letters
            hidden = self._weight(undone(text)) if thrice else 0.0
        else:
            letters = sum(c.isalpha() for c in core)
            mixed, thrice = 1 < letters < len(core), THRICE.search(word) is not None
            hidden = self._weight(undone(text))
        return max(weight, hidden), hidden >= MEDIUM and hidden > weight, word in SECOND_PERSON, len(core) > 1 and core.isupper(), mixed, thrice

    def __call__(self, column: pa.Array) -> np.ndarray:
        split = [t.split() for t in column.to_pylist()]
        rows, n = len(split), np.fromiter(map(len, split), np.int64, len(split))
        flat, _ = self.cache.expand(self.cache.places([w for s in split for w in s]))
        weight, lifted, second, capital, mixed, thrice = flat.reshape(-1, 6).T
        strong, medium = weight >= STRONG, weight >= MEDIUM
        row = np.repeat(np.arange(rows), n)
        total = lambda x: np.bincount(row, weights=x, minlength=rows)
        # words between a term and the nearest word for the second person of its text
        gap = np.full(len(row), 50)
        you = np.flatnonzero(second)
        if len(you):
            at = np.flatnonzero(medium)
            after = np.searchsorted(you, at)
            for side in (np.maximum(after - 1, 0), np.minimum(after, len(you) - 1)):
                distance = np.where(row[you[side]] == row[at], np.abs(you[side] - at), 50)
                gap[at] = np.minimum(gap[at], distance)
        nearest = np.full(rows, 50)
        np.minimum.at(nearest, row, gap)
        highest = np.zeros(rows)
        np.maximum.at(highest, row, weight)
        data, bounds = joined_bytes(column)
        size = np.diff(bounds)
        count = lambda flags: sums_by_row(flags.astype(np.int64), size)
        upper, letter = (data >= 65) & (data <= 90), ((data | 32) >= 97) & ((data | 32) <= 122)
        figure = (data >= 48) & (data <= 57)
        sign = (data > 32) & (data < 127) & ~letter & ~figure
        some, words = np.maximum(size, 1), np.maximum(n, 1)
        out = [
            np.log1p(n), total(strong) / words, np.log1p(total(strong)), total(medium) / words, highest, total(np.where(medium, weight, 0)) / words,
            total(gap <= NEAR) / words, nearest, total(second) / words, count(upper) / np.maximum(count(letter), 1), total(capital) / words,
            count(data == 33) / some, count(data == 63) / some, count(sign) / some, count(figure) / some, total(mixed) / words,
            total(lifted) / words, total(thrice) / words, size / words,
        ]
        return np.stack([np.asarray(x, np.float64) for x in out], axis=1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms and in how many texts of each group they are (groups: half x label)."""

    def out() -> pa.RecordBatch:
        counts = np.array(list(held.values()), np.int64).reshape(-1, 4)
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array(c) for c in counts.T.copy())], ["term", "n0", "n1", "n2", "n3"])

    held: dict[str, list[int]] = {}
    for batch in slices(batches):
        for text, group in zip(batch.column("text").to_pylist(), batch.column("group").to_pylist(), strict=True):
            words = set(text.split())
            for term in {t for w in words if (word := plain(w.decode("utf-8", "replace"))) for t in terms(word)}:
                held.setdefault(term, [0, 0, 0, 0])[group] += 1
        if len(held) > TERMS_HELD:
            yield out()
            held = {}
    yield out()


def _lexicon(counts: DataFrame, clean: F.Column, toxic: F.Column, n_clean: int, n_toxic: int) -> dict[str, float]:
    """Terms with the highest log odds; few by LEXICON."""
    weight = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    rows = counts.where((toxic >= LEAST_TEXTS) & (weight >= MEDIUM)).select("term", F.round(weight, 6).alias("weight"))
    return {r.term: r.weight for r in rows.orderBy(F.desc("weight"), "term").limit(LEXICON).collect()}


def _kept(name: str, lexicon: dict[str, float]) -> Featurizer:
    """One featurizer of a lexicon in each worker."""
    if _WORKER.get(name, (None, None))[0] != lexicon:
        _WORKER[name] = (lexicon, Featurizer(lexicon))
    return _WORKER[name][1]


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _sample_features(lexicons: list[dict[str, float]]):
    """Features of sampled rows, each by the lexicon that has not seen it (`by` says which)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            by = np.asarray(batch.column("by"))
            for k, lexicon in enumerate(lexicons):
                at = pa.array(np.flatnonzero(by == k))
                if len(at):
                    some = batch.take(at)
                    x = _kept(f"sample{k}", lexicon)(some.column("text"))
                    yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("label", "weight", "by", "digest")), _lists(x)], ["label", "weight", "by", "digest", "x"])

    return run


@dataclass
class Model:
    """What scores a text. Without trees (one of the two labels is missing) every score is `share`."""

    lexicon: dict[str, float]
    share: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None


def held_out(id_: F.Column) -> F.Column:
    """Rows that are never learnt from: a fifth, by the crc32 of the id as text."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", toxic: int = TOXIC, clean: int = CLEAN) -> Model:
    """Learns from up to `toxic` and `clean` labelled documents that are not held out.

    A kind of which not all rows are taken counts as much as it has rows. Null labels are left out; of several
    labels of an id the greatest counts, of several documents of an id one; ids without a document teach nothing.
    A quarter of the sample calibrates. The rest makes the lexicon and grows the trees: in two halves, each of
    which has its features by the lexicon of the other, so that trees learn what the lexicon does on new texts.
    """
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull() & ~held_out(F.col(id_column)))
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label_column).cast("int")).alias("label"))
    total = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).where("label in (0, 1)").collect()}
    if len(total) < 2:
        return Model({}, float(1 in total))
    order = (F.xxhash64("id"), "id")
    limits = {0: clean, 1: toxic}
    chosen = known.where("label = 0").orderBy(*order).limit(clean).union(known.where("label = 1").orderBy(*order).limit(toxic))
    # the ids are few by these limits and are sent to the texts
    rows = docs.select(F.col(id_column).alias("id"), text_bytes(text_column).alias("text")).join(F.broadcast(chosen), "id").dropDuplicates(["id"])
    weight = F.when(F.col("label") == 1, max(1.0, total[1] / limits[1])).otherwise(max(1.0, total[0] / limits[0]))
    digest = F.xxhash64("id", F.lit(3))
    # by: 2 calibrates; 0 and 1 are the halves
    part = F.when(F.pmod(digest, F.lit(CALIBRATION)) == 0, 2).otherwise(F.pmod(F.shiftright(digest, 8), F.lit(2))).cast("int")
    sample = stored(rows.select("label", weight.alias("weight"), part.alias("by"), digest.alias("digest"), "text"), "toxicity-sample")
    sizes = {(r.by, r.label): r.n for r in sample.groupBy("by", "label").agg(F.count("*").alias("n")).collect()}
    grouped = sample.where("by < 2").select("text", (2 * F.col("by") + F.col("label")).alias("group"))
    counts = grouped.mapInArrow(_counted, "term string, n0 long, n1 long, n2 long, n3 long").groupBy("term").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "n2", "n3")))
    counts = stored(counts.where(F.col("n1") + F.col("n3") >= LEAST_TEXTS), "toxicity-terms")
    n = [[sizes.get((by, label), 0) for label in (0, 1)] for by in (0, 1)]
    halves = [_lexicon(counts, F.col(f"n{2 * k}"), F.col(f"n{2 * k + 1}"), *n[k]) for k in (0, 1)]
    lexicon = _lexicon(counts, F.col("n0") + F.col("n2"), F.col("n1") + F.col("n3"), n[0][0] + n[1][0], n[0][1] + n[1][1])
    found = sample.mapInArrow(_sample_features([halves[1], halves[0], lexicon]), "label int, weight double, by int, digest long, x array<double>")
    # one task in one order, so that sums of doubles come out the same in every run; few rows by the limits
    found = stored(found.repartition(1).sortWithinPartitions("digest", "x"), "toxicity-features").select("label", "weight", "by", array_to_vector("x").alias("x"))
    share = total[1] / (total[0] + total[1])
    if any(sum(sizes.get((by, label), 0) for by in (0, 1)) == 0 for label in (0, 1)):
        return Model(lexicon, share)
    trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED)
    trees = trees.setProbabilityCol("p").fit(found.where("by < 2").coalesce(1))
    model = Model(lexicon, share, trees)
    if all(sizes.get((2, label), 0) for label in (0, 1)):
        raw = trees.transform(found.where("by = 2").coalesce(1)).select("label", "weight", vector_to_array("p")[1].alias("p"))
        model.calibration = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight", predictionCol="score").fit(raw)
    return model


def _features(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer = _kept("all", lexicon)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(featurizer(batch.column("text")))], ["id", "x"])

    return run


def features(docs: DataFrame, lexicon: dict[str, float], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and x, the features of every row in the order of FEATURES."""
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_bytes(text_column).alias("text"))
    return rows.mapInArrow(_features(lexicon), f"id {kind}, x array<double>")


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", cut: float = CUT) -> DataFrame:
    """id, held_out, score (0 to 1) and predicted of every row, read and scored in place.

    A null text is empty; empty texts have features of 0 and a score like any other. Null ids are not held out;
    repeated rows give a row each and equal texts equal scores; further columns are left out; an empty table gives
    an empty result. Without labels of both kinds all scores are the same: 1 if all are toxic, else 0.
    """
    found = features(docs, model.lexicon, id_column, text_column)
    if model.trees is None:
        found = found.withColumn("score", F.lit(model.share))
    else:
        found = model.trees.transform(found.withColumn("x", array_to_vector("x"))).withColumn("p", vector_to_array("p")[1])
        found = model.calibration.transform(found) if model.calibration else found.withColumnRenamed("p", "score")
    score = F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0))
    return found.select("id", held_out(F.col("id")).alias("held_out"), score.alias("score"), F.when(score >= cut, 1).otherwise(0).alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")
