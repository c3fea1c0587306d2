"""Operator 8: token counts by compiled finite-state transducers.

Two deterministic transducers in a row. The first reads characters and marks where the tokenizer's own pieces
(words with their blank, numbers, signs, white space) begin; it has twelve states. Text is cut into chunks of
equal length wherever they fall; each chunk's map from entry state to exit state is worked out for all chunks at
once, the maps compose by a parallel prefix scan, and then every chunk knows its entry state and emits. The
second reads the bytes of a piece and counts tokens: a transition carries how many tokens the reading of one
more byte adds. It is compiled as far as the data asks for, and shared by all pieces of a worker.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.bpe import MergeRule
from punctual.llm.common import PieceCache, slices, sums_by_row, table, text_bytes

CHUNK = 128
LIMIT_TOKENS = 1024
STATES_KEPT = 250_000
TRANSITIONS_KEPT = 400_000
_WORKER: dict = {}

# States: after a finished piece; in letters, numbers, signs; after an apostrophe that began a piece, and after
# r, v, l following it; after one blank, one other white space, several ending in a blank, in another.
FRESH, LETTERS, NUMBERS, SIGNS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, BLANK, SPACE, BLANKS, SPACES = range(12)
# Character classes: letters, some of which can follow an apostrophe; end stands between texts.
OTHER_LETTER, SHORT, R, V, L, E, NUMBER, A_BLANK, A_SPACE, APOSTROPHE, SIGN, END = range(12)
# What a transition emits: a piece begins at this character, at the one before.
HERE, BEFORE = 1, 2


def piece_machine() -> tuple[np.ndarray, np.ndarray]:
    """next state and emission by (state, class) for the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?signs|white space not before text|white space."""
    kind = {c: LETTERS for c in (OTHER_LETTER, SHORT, R, V, L, E)} | {NUMBER: NUMBERS, SIGN: SIGNS, APOSTROPHE: QUOTE, A_BLANK: BLANK, A_SPACE: SPACE}
    following = np.zeros((12, 12), np.int64)
    emitted = np.zeros((12, 12), np.uint8)
    for state in range(12):
        for c in range(11):
            to, out = kind[c], HERE
            if state in (LETTERS, NUMBERS) and to == state:
                out = 0
            elif state in (SIGNS, QUOTE) and c in (SIGN, APOSTROPHE):
                to, out = SIGNS, 0
            elif state == QUOTE and c in (SHORT, R, V, L):
                to, out = {SHORT: FRESH, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[c], 0
            elif state in (QUOTE_R, QUOTE_V, QUOTE_L):
                if c == (L if state == QUOTE_L else E):
                    to, out = FRESH, 0
                else:
                    out = BEFORE if to == LETTERS else BEFORE | HERE
            elif state in (BLANK, SPACE, BLANKS, SPACES):
                if c in (A_BLANK, A_SPACE):
                    to, out = (BLANKS if c == A_BLANK else SPACES), 0
                else:
                    out = {BLANK: 0, SPACE: HERE, BLANKS: BEFORE, SPACES: BEFORE | HERE}[state]
                    if c == APOSTROPHE and state in (BLANK, BLANKS):
                        to = SIGNS
            following[state, c], emitted[state, c] = to, out
        following[state, END], emitted[state, END] = FRESH, BEFORE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0
    return following, emitted


def character_classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    every = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(0x110000)]
    text = "".join(every)
    classes = np.full(0x110000, SIGN, np.uint8)
    for pattern, c in ((r"\p{L}+", OTHER_LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", A_SPACE)):
        for m in regex.finditer(pattern, text):
            classes[m.start() : m.end()] = c
    classes[0xD800:0xE000] = SIGN
    for letters, c in (("stmd", SHORT), ("r", R), ("v", V), ("l", L), ("e", E), (" ", A_BLANK), ("'", APOSTROPHE)):
        classes[[ord(x) for x in letters]] = c
    return classes


def compose(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """State maps of neighbouring stretches: through `first`, then `second`."""
    return np.take_along_axis(second, first, axis=1)


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """maps[i] becomes the map of stretches 0 to i, in a logarithmic number of steps."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = compose(maps[:-step], maps[step:])
        step *= 2
    return maps


class PieceSplitter:
    """Where pieces begin in a row of texts."""

    def __init__(self):
        self.following, self.emitted = piece_machine()
        self.classes = character_classes()
        self.flat_following, self.flat_emitted = self.following.ravel().astype(np.uint8), self.emitted.ravel()

    def begins(self, points: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """A flag per code point; a code point of 0x110000 and more ends a text and is no part of a piece."""
        ended = points >= 0x110000
        classes = np.where(ended, END, self.classes[np.minimum(points, 0x10FFFF)]).astype(np.uint8)
        n = len(classes)
        rows = max(1, -(-n // chunk))
        grid = np.full(rows * chunk, END, np.uint8)
        grid[:n] = classes
        grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)
        maps = np.broadcast_to(np.arange(12, dtype=np.uint8), (rows, 12)).copy()
        for i, column in enumerate(grid):
            maps = self.flat_following[maps * np.uint8(12) + column[:, None]]
            if maps.shape[1] > 1 and i % 8 == 7 and (maps == maps[:, :1]).all():
                maps = maps[:, :1].copy()  # whatever the entry state, the exit is the same by now
        maps = np.broadcast_to(maps, (rows, 12))
        state = np.concatenate([[FRESH], prefix_scan(maps)[:-1, FRESH]]).astype(np.uint8)
        out = np.empty((chunk, rows), np.uint8)
        for i, column in enumerate(grid):
            at = state * np.uint8(12) + column
            out[i], state = self.flat_emitted[at], self.flat_following[at]
        flags = out.T.reshape(-1)[:n]
        begins = (flags & HERE) > 0
        begins[:-1] |= (flags[1:] & BEFORE) > 0
        return begins


class CountingMachine:
    """Bytes of a piece to its number of tokens.

    A state holds, for the piece read so far, the longest end of it that is the beginning of a token, and for
    each place in that end where a token may have begun: how far back it is, the last token before it, and how
    many tokens lie between. Pieces that agree in this share the state, whatever came before.
    """

    def __init__(self, tokens: dict[bytes, int]):
        self.tokens = tokens
        self.rule = MergeRule(tokens)
        self.beginnings = {t[:i] for t in tokens for i in range(1, len(t) + 1)}
        self.clear()

    def clear(self) -> None:
        self.states: list = [(b"", ((0, None, 0),))]
        self.numbers = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def count(self, piece: bytes) -> int:
        if piece in self.tokens and self.rule.suits(None, piece):
            return 1
        state = total = 0
        moves = self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._compile(state, byte)
            state, added = move
            total += added
        return total

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        end, places = self.states[state]
        end += bytes([byte])
        token, added, kept = None, 0, []
        for length, last, more in places:
            tail = end[len(end) - length - 1 :]
            if tail in self.beginnings:
                kept.append((length + 1, last, more))
                if token is None and tail in self.tokens and self.rule.suits(last, tail):
                    token, added = tail, more + 1
        if token is None:
            raise ValueError("a byte is no token of this vocabulary")
        longest = kept[0][0] if kept else 0
        new = (end[len(end) - longest :], (*((length, last, more - added) for length, last, more in kept), (0, token, 0)))
        number = self.numbers.setdefault(new, len(self.states))
        if number == len(self.states):
            self.states.append(new)
        move = self.moves[state << 8 | byte] = (number, added)
        return move

    def counts(self, pieces: list[bytes]) -> list[np.ndarray]:
        if len(self.states) > STATES_KEPT or len(self.moves) > TRANSITIONS_KEPT:
            self.clear()
        return np.array([self.count(p) for p in pieces], np.int32)[:, None]


def byte_tokens(path: str) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """Tokens of a byte-level vocabulary as bytes with their merge ranks; special tokens with their ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    raw = lambda shown_text: bytes(byte_of[c] for c in shown_text)
    special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ranks = {bytes([b]): -1 for b in range(256)}
    for rank, (left, right) in enumerate(pairs):
        ranks.setdefault(raw(left) + raw(right), rank)
    return ranks, special


class TokenCounter:
    def __init__(self, path: str):
        tokens, self.special = byte_tokens(path)
        self.machine = CountingMachine(tokens)
        self.splitter = PieceSplitter()
        self.cache = PieceCache(self.machine.counts)

    def counts(self, texts: list[bytes]) -> np.ndarray:
        parts, fixed, owner = [], np.zeros(len(texts), np.int64), []
        for i, text in enumerate(texts):
            pending = [text]
            for special in self.special:
                if special in text:
                    pending = [y for x in pending for y in x.split(special)]
            fixed[i] = len(pending) - 1
            parts += pending
            owner += [i] * len(pending)
        points, bounds = [], []
        for part in parts:
            points.append(np.frombuffer(part.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32))
            points.append(np.array([0x110000], np.uint32))
            bounds.append(len(points[-2]))
        joined = np.concatenate(points)
        begins = np.flatnonzero(self.splitter.begins(joined))
        ends = np.cumsum(np.array(bounds) + 1)
        width = 1 + (joined >= 0x80).astype(np.int64) + (joined >= 0x800) + (joined >= 0x10000)
        width[joined >= 0x110000] = 1
        at = np.concatenate([[0], np.cumsum(width)])
        data = b"\n".join(parts) + b"\n"
        if at[-1] != len(data):
            data = b"\n".join(p.decode("utf-8", "replace").encode() for p in parts) + b"\n"
        stops = np.concatenate([begins[1:], [len(joined)]])
        part_of = np.searchsorted(ends, begins, side="right")
        stops = np.minimum(stops, ends[part_of] - 1)
        pieces = [data[a:b] for a, b in zip(at[begins].tolist(), at[stops].tolist(), strict=True)]
        counted, _ = self.cache.expand(self.cache.places(pieces))
        per_part = np.bincount(part_of, weights=counted, minlength=len(parts)).astype(np.int64)
        return fixed + np.bincount(np.array(owner, np.int64), weights=per_part, minlength=len(texts)).astype(np.int64)


def _counter(path: str) -> TokenCounter:
    if path not in _WORKER:
        _WORKER[path] = TokenCounter(path)
    return _WORKER[path]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in slices(batches, limit=1 << 20):
            counts = counter.counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), pa.array(counts)], ["id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, limit_tokens: int = LIMIT_TOKENS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit for every row.

    Counts equal those of the tokenizers library for a byte-level vocabulary, without added special tokens;
    strings of special tokens inside a text count as one, as the library does by default. Null and empty texts
    have 0 bytes and 0 tokens; repeated rows and rows without an id give a row each; further columns are left
    out; an empty table gives an empty result. No shuffle: each row is counted where it is read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_bytes(text_column).alias("text"))
    rows = rows.select("id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(_count(tokenizer_path), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select("id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit_tokens).alias("over_limit"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumnRenamed("id", "doc_id")
