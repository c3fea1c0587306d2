"""Operator 3: substring dedup on words by recompression.

Words are named, then rounds of recompression name runs of equal symbols and pairs of neighbours, the left one
from one half of the symbols and the right one from the other; the halves change with the round. A name is a
digest of what it stands for, so every Spark task gives equal things the same name and the rounds need no shuffle
and no dictionary. Equal stretches of text hold the same symbols inside; only near their ends may what stands
outside decide. So each symbol knows the stretch that decided it. A window of 50 words is anchored on the
symbols of the highest level that were decided inside it, and shared anchors reveal and verify the repeats
(see `windows`).
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from xxhash import xxh3_64_intdigest

from punctual.llm.common import mix, stored, table
from punctual.llm.windows import POSITION_BITS, Scanned, covered, cut_texts, gaps_of, keyed_texts, repeated_windows, span_lists

WINDOW = 50
ROUNDS = 6
RUN_ROUNDS = (0,)
_LOW = np.uint64((1 << POSITION_BITS) - 1)
_WORKER: dict = {}


class Level:
    """Symbols in order: name, where each starts, the stretch of words that decided it, its text."""

    def __init__(self, name: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray, text: np.ndarray):
        self.name, self.start, self.low, self.high, self.text = name, start, low, high, text

    def joined_to_next(self) -> np.ndarray:
        return np.concatenate([self.text[1:] == self.text[:-1], [False]]) if len(self.text) else np.zeros(0, bool)

    def neighbours(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where what decided the symbol before begins, and that of the one after ends. At the ends of a text the
        end itself decides, which no window shows: one place outside."""
        near = self.joined_to_next()
        before = np.where(np.concatenate([[False], near[:-1]]), np.concatenate([[0], self.low[:-1]]), bounds[self.text] - 1)
        after = np.where(near, np.concatenate([self.high[1:], [0]]), bounds[self.text + 1] + 1)
        return before, after

    def runs(self, bounds: np.ndarray) -> Level:
        """Runs of equal symbols become one; that a symbol stands alone is seen from its neighbours."""
        if not len(self.name):
            return self
        near = self.joined_to_next()
        begins = np.flatnonzero(np.concatenate([[True], ~(near[:-1] & (self.name[1:] == self.name[:-1]))]))
        ends = np.concatenate([begins[1:], [len(self.name)]]) - 1
        before, after = self.neighbours(bounds)
        length = ends - begins + 1
        name = np.where(length > 1, mix(self.name[begins], length.astype(np.uint64)), self.name[begins])
        return Level(name, self.start[begins], before[begins], after[ends], self.text[begins])

    def pairs(self, turn: int, bounds: np.ndarray) -> Level:
        """A left symbol and a right one after it become one; a symbol stays if its neighbour does not suit."""
        if not len(self.name):
            return self
        left = (mix(self.name, np.full(len(self.name), turn, np.uint64)) & np.uint64(1)) == 0
        near = self.joined_to_next()
        first = near & left & np.concatenate([~left[1:], [False]])
        second = np.concatenate([[False], first[:-1]])
        before, after = self.neighbours(bounds)
        low = np.where(first | left, self.low, before)
        high = np.where(first, np.concatenate([self.high[1:], [0]]), np.where(left, after, self.high))
        name = np.where(first, mix(self.name, np.concatenate([self.name[1:], [0]]).astype(np.uint64)), self.name)
        kept = ~second
        return Level(name[kept], self.start[kept], low[kept], high[kept], self.text[kept])


class Recompressor:
    def __call__(self, column: pa.Array) -> Scanned:
        split = [t.split() for t in column.to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in split])]).astype(np.int64)
        # naming a word takes less time than looking up whether it has a name
        words = np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(split)), np.uint64, int(bounds[-1]))
        return self.scan(words, bounds)

    def scan(self, words: np.ndarray, bounds: np.ndarray) -> Scanned:
        named = np.concatenate([words, np.zeros(2 * WINDOW, np.uint64)])
        for offset in (1, 2, 4, 8, 16):
            named = mix(named[:-offset], named[offset:])

        def window_names(places: np.ndarray) -> np.ndarray:
            return mix(named[places], named[places + WINDOW - 32])

        return Scanned(bounds, WINDOW, lambda: self.anchors(words, bounds), window_names)

    def anchors(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        here = np.arange(n)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        levels = [Level(words, here, here, here + 1, text)]
        for turn in range(ROUNDS):
            level = levels[-1]
            levels.append((level.runs(bounds) if turn in RUN_ROUNDS else level).pairs(turn, bounds))
        # windows that hold no symbol of a level go on to the one below; a word is decided by itself
        anchor, names, rest = np.zeros(n, np.int64), np.zeros(n, np.uint64), here
        for number in reversed(range(len(levels))):
            place, name = self.chosen(levels[number], rest, number)
            found = place >= 0
            anchor[rest[found]], names[rest[found]] = place[found], name[found]
            rest = rest[~found]
        return anchor, names

    @staticmethod
    def chosen(level: Level, windows: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """By window: place and name of the least symbol of this level that was decided inside it; -1 if none was."""
        m = len(level.name)
        if not m:
            return np.full(len(windows), -1), np.zeros(len(windows), np.uint64)
        first = np.searchsorted(level.low, windows, side="left")
        stop = np.searchsorted(level.high, windows + WINDOW, side="right")
        count = stop - first
        ranked = (mix(level.name) & ~_LOW) | np.arange(m, dtype=np.uint64)
        least, ladder, size = np.zeros(len(windows), np.uint64), ranked, 1
        while True:
            here = np.flatnonzero((count >= size) & (count < 2 * size))
            least[here] = np.minimum(ladder[first[here]], ladder[stop[here] - size])
            if 2 * size > min(WINDOW, m):
                break
            ladder = np.minimum(ladder[: len(ladder) - size], ladder[size:])
            size *= 2
        symbol = (least & _LOW).astype(np.int64)
        some = count > 0
        return np.where(some, level.start[symbol], -1), np.where(some, mix(level.name[symbol], np.full(len(symbol), number, np.uint64)), np.uint64(0))


def _make_scan() -> Recompressor:
    if "scan" not in _WORKER:
        _WORKER["scan"] = Recompressor()
    return _WORKER["scan"]


def _found(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    texts = keyed_texts(docs, id_column, text_column)
    gaps = stored(gaps_of(texts, _make_scan), "word-gaps")
    return texts, repeated_windows(gaps, texts, _make_scan, earlier=True)


def _kept(batch: pa.RecordBatch) -> tuple[list[int], list[bytes]]:
    sizes, kept = [], []
    for text, spans in zip(batch.column("text").to_pylist(), span_lists(batch), strict=True):
        words = text.split()
        sizes.append(len(words))
        if spans:
            gone = covered(len(words), spans, WINDOW).tolist()
            words = [w for w, g in zip(words, gone, strict=True) if not g]
        kept.append(words)
    return sizes, kept


def _digests(batch: pa.RecordBatch) -> list[pa.Array]:
    sizes, kept = _kept(batch)
    removed = [n - len(words) for n, words in zip(sizes, kept, strict=True)]
    digests = [hashlib.sha256(b" ".join(words)).hexdigest() for words in kept]
    return [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]


def repeat_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words, n_removed, kept_sha256 of every row, without the words of windows that an earlier row has.

    A window is 50 consecutive words of a row. A word goes if a window over it also starts in a row of a smaller
    id; null ids come after all others, and rows of equal id take nothing from each other. Null, empty and
    shorter texts keep their words; further columns are left out; an empty table gives an empty result.
    """
    texts, spans = _found(docs, id_column, text_column)
    return cut_texts(texts, spans, _digests, ["n_words", "n_removed", "kept_sha256"], "n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and text of every row, the kept words joined by one blank."""

    def texts_of(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([b" ".join(words).decode("utf-8", "replace") for words in _kept(batch)[1]], pa.string())]

    texts, spans = _found(docs, id_column, text_column)
    return cut_texts(texts, spans, texts_of, ["kept"], "kept string").withColumnRenamed("kept", "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


ORACLE = f"""
with words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents)),
windows as (select doc_id, pos, word, count(*) over w as n, md5(string_agg(word, ' ') over w) as h from words
    window w as (partition by doc_id order by pos rows between current row and {WINDOW - 1} following)),
firsts as (select h, min(doc_id) as first_doc from windows where n = {WINDOW} group by h),
ends as (select w.doc_id, w.pos, w.word, max(coalesce(cast(f.first_doc < w.doc_id as int), 0)) over (
    partition by w.doc_id order by w.pos rows between {WINDOW - 1} preceding and current row) as gone
    from windows w left join firsts f on w.n = {WINDOW} and f.h = w.h)
select d.doc_id, count(e.pos) as n_words, cast(coalesce(sum(e.gone), 0) as bigint) as n_removed,
    sha256(coalesce(string_agg(e.word, ' ' order by e.pos) filter (where e.gone = 0), '')) as kept_sha256
from documents d left join ends e using (doc_id) group by d.doc_id
"""
