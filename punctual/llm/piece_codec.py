"""Operator 6: SentencePiece encoding and decoding by suffix-array matching.

Text is normalised by the model's own rules and cut where no piece of the vocabulary can cross (in front of a
blank's mark that follows other text, around line ends, between letters that no piece holds side by side). The
parts of a batch that a worker has not met yet are joined to one text; its suffix array is built as deep as the longest piece; a binary search of every piece
gives its range of occurrences. Each occurrence is an edge from its first to its last place. The edges, sorted by
position, are relaxed once from left to right.

For a byte-pair model the relaxation is not a sum of scores but the rule of `bpe.MergeRule`: the edge is taken
that may follow the token its start was reached by. Exactly one can, and the result is the model's own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.bpe import MergeRule
from punctual.llm.common import PieceCache, give_back, kept_by_worker, slices, sums_by_row, table, text_bytes

MARK = "▁"
INDEXED_CHARACTERS = 200_000
PARTS_KEPT = 500_000
PAIRS_KEPT = 400_000
OWN = -1  # a character that is a token of its own and in no piece


class PieceCodec:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.id_of = {names[i]: i for i in plain}
        self.rule = MergeRule({names[i]: -model.get_score(i) for i in plain})
        self.unknown = model.unk_id()
        self.depth = max(map(len, self.id_of))
        if any(MARK in name.lstrip(MARK) for name in self.id_of):
            raise ValueError("pieces of this model cross blanks; its texts cannot be cut there")
        apart = "".join(c for c in "\n\t\r" if not any(c in name for name in self.id_of))
        self.stretch = re.compile(f"{MARK}+[^{MARK}{apart}]*|[^{MARK}{apart}]+|[{apart}]" if apart else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        letters = sorted({c for name in self.id_of for c in name})
        self.letter = np.zeros(0x110001, ">u2")
        self.letter[[ord(c) for c in letters]] = np.arange(2, len(letters) + 2)
        self.pieces = sorted(self.id_of)
        self.piece_ids = [self.id_of[name] for name in self.pieces]
        low = np.zeros((len(self.pieces), self.depth), ">u2")
        for i, name in enumerate(self.pieces):
            low[i, : len(name)] = self.letter[[ord(c) for c in name]]
        high = low.copy()
        high[low == 0] = 0xFFFF
        self.low, self.high = self._keys(low), self._keys(high)
        self.lengths = np.array([len(name) for name in self.pieces])
        beside = {(ord(a), ord(b)) for name in self.id_of for a, b in zip(name[:-1], name[1:], strict=True)}
        left, right = (self.letter[list(side)].astype(np.int64) for side in zip(*beside, strict=True))
        self.pairs = np.sort(left << 16 | right)
        self.parts: dict[str, tuple[int, ...]] = {}  # tuples, which the garbage collector need not visit
        self.follows: dict[int, bool] = {}  # two pieces as one number: whether the second may follow the first
        self.cache = PieceCache(self._encode_stretches, limit=350_000)
        self.decoded = [self._shown(i, names[i]) for i in range(size)]

    def _shown(self, i: int, name: str) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(name[3:5], 16)])
        if self.model.is_control(i):
            return b""
        return " ⁇ ".encode() if self.model.is_unknown(i) else name.replace(MARK, " ").encode()

    def _keys(self, letters: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(letters).view(f"S{2 * self.depth}").ravel()

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and piece of every occurrence of a piece in `text`, by end and then length, longest first."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        padded = np.zeros(len(points) + self.depth, ">u2")
        padded[: len(points)] = np.where(self.letter[points] == 0, 1, self.letter[points])  # 1: in no piece
        windows = self._keys(np.lib.stride_tricks.sliding_window_view(padded, self.depth)[: len(points)])
        suffixes = np.argsort(windows, kind="stable")
        ordered = windows[suffixes]
        first = np.searchsorted(ordered, self.low, side="left")
        counts = np.searchsorted(ordered, self.high, side="right") - first
        total = int(counts.sum())
        at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(total)
        start = suffixes[at]
        piece = np.repeat(np.arange(len(self.pieces)), counts)
        end = start + self.lengths[piece]
        order = np.lexsort((start, end))
        return start[order], end[order], piece[order]

    def _encode_stretches(self, stretches: list[str]) -> list[tuple[int, ...]]:
        """By parts: two neighbours that no piece holds side by side cannot end up in one token."""
        if len(self.parts) > PARTS_KEPT:
            self.parts.clear()
        text = "\x00".join(stretches) + "\x00"
        ends = np.cumsum([len(s) + 1 for s in stretches]) - 1  # the places of the separators
        letters = self.letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int64)
        pairs = letters[:-1] << 16 | letters[1:]
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        starts = np.concatenate([[0], np.flatnonzero(self.pairs[at] != pairs) + 1])
        stops = np.concatenate([starts[1:], [len(text)]])
        inside = ~np.isin(starts, ends)
        starts, stops = starts[inside], stops[inside]
        parts = [text[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        known = self.parts
        new = [p for p in dict.fromkeys(parts) if p not in known]
        some, size = [], 0
        for part in new:
            some.append(part)
            size += len(part) + 1
            if size > INDEXED_CHARACTERS:
                known.update(zip(some, self._relaxed(some), strict=True))
                some, size = [], 0
        if some:
            known.update(zip(some, self._relaxed(some), strict=True))
        counts = np.bincount(np.searchsorted(ends, starts), minlength=len(stretches))
        bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
        return [known[parts[a]] if b == a + 1 else tuple(chain.from_iterable(map(known.__getitem__, parts[a:b]))) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _relaxed(self, stretches: list[str]) -> list[tuple[int, ...]]:
        text = "\x00".join(stretches) + "\x00"
        starts, ends, pieces = self.edges(text)
        bounds = np.searchsorted(ends, np.arange(len(text) + 2)).tolist()  # by place: its edges, the longest first
        starts, pieces = starts.tolist(), pieces.tolist()
        if len(self.follows) > PAIRS_KEPT:
            self.follows.clear()
        follows, names, size = self.follows, self.pieces, len(self.pieces)
        known, suits = follows.get, self.rule.suits
        token = [OWN] * (len(text) + 1)  # by place: the piece that ends there
        came = list(range(-1, len(text)))  # and where it starts
        place = 0
        out = []
        for stretch in stretches:
            begin, stop = place, place + len(stretch)
            for here in range(begin + 1, stop + 1):
                for i in range(bounds[here], bounds[here + 1]):
                    start, piece = starts[i], pieces[i]
                    if start > begin:
                        left = token[start]
                    elif start == begin:
                        left = size
                    else:
                        continue
                    if left == OWN:
                        found = suits(text[start - 1], names[piece])
                    else:
                        key = left * size + piece
                        found = known(key)
                        if found is None:
                            found = follows[key] = suits(None if left == size else names[left], names[piece])
                    if found:
                        token[here], came[here] = piece, start
                        break
            found, here = [], stop
            while here > begin:
                piece = token[here]
                if piece >= 0:
                    found.append(self.piece_ids[piece])
                else:
                    found += self._own(text[here - 1])
                here = came[here]
            out.append(tuple(found[::-1]))
            place = stop + 1
        return out

    def _own(self, letter: str) -> list[int]:
        """The ids of a character that no piece ends with here, the last first."""
        known = self.id_of.get(letter)
        if known is not None:
            return [known]
        if self.byte_ids:
            return [self.byte_ids[b] for b in reversed(letter.encode("utf-8", "replace"))]
        return [self.unknown]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        split = [self.stretch.findall(self.model.normalize(t)) if t else [] for t in texts]
        places = self.cache.places([s for one in split for s in one])
        ids, lengths = self.cache.expand(places)
        return ids, sums_by_row(lengths, np.fromiter(map(len, split), np.int64, len(split)))

    def decode(self, ids: np.ndarray) -> str:
        """The text of a row of ids, without the blank that encoding puts in front."""
        shown = self.decoded
        text = b"".join([shown[i] for i in ids.tolist()])
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


def _codec(path: str) -> PieceCodec:
    return kept_by_worker(f"pieces of {path}", lambda: PieceCodec(path))


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in slices(batches):
            ids, counts = codec.encode([t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids, pa.int32()))
            kept = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(counts, pa.int32()), lists], [*(batch.schema.names[i] for i in kept), "n_tokens", "ids"])
        give_back()

    return run


def encode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_tokens and ids of every row, equal to the library's for a byte-pair model.

    Null and empty texts have no ids; repeated rows and rows without an id give a row each; further columns are
    left out; an empty table gives an empty result. Nothing is shuffled.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_bytes(text_column).alias("text"))
    return rows.mapInArrow(_encode(model_path), f"id {kind}, n_tokens int, ids array<int>")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            lists = batch.column("ids")
            offsets = np.asarray(lists.offsets)
            values = np.asarray(lists.values)
            for first in range(0, batch.num_rows, 500):
                bounds = offsets[first : first + 501]
                texts = [codec.decode(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, 500), pa.array(texts, pa.string())], ["id", "text"])

    return run


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """id and text of rows with id and ids; null or empty lists give the empty text."""
    kind = encoded.schema["id"].dataType.simpleString()
    rows = encoded.select("id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(_decode(model_path), f"id {kind}, text string")


def _digest(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in slices(batches):
            texts = [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            ids, counts = codec.encode(texts)
            ends = np.cumsum(counts)
            each = [ids[a:b] for a, b in zip(ends - counts, ends, strict=True)]
            crc = [zlib.crc32(np.ascontiguousarray(x, "<u4")) for x in each]
            same = [codec.decode(x) == t for x, t in zip(each, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts), pa.array(crc, pa.int64()), pa.array(same)], ["id", "n_tokens", "ids_crc32", "round_trip"])
        give_back()

    return run


def digests(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers) and whether decoding gives the text back.

    Rows and nulls as in `encode`. A text that holds the blank's own mark comes back with blanks instead.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_bytes(text_column).alias("text"))
    return rows.mapInArrow(_digest(model_path), f"id {kind}, n_tokens long, ids_crc32 long, round_trip boolean")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), model_path()).withColumnRenamed("id", "doc_id")
