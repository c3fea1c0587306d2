"""Operator 1: token ids in Parquet files, for reads of some documents or of the metadata alone.

File format: one row per document in ascending id order over the files of a folder: id, ids (list of int32,
dictionary-encoded; delta-packed where a dictionary does not pay), n_tokens, part and local_start (tokens of
the same part before it). Row groups and pages are kept small and carry page indexes, so a filter on the id
reads a few pages, and metadata reads skip the ids.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from punctual.llm.common import PieceCache, new_path, slices, sums_by_row, table, text_bytes, uncollected

ROW_GROUP_BYTES = 8 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 500
FILE_SCHEMA = "part int, local_start long, n_tokens int, ids array<int>"
PIECES_KEPT = 300_000
# Texts and words of white space, ASCII signs and Latin-1 letters, and the cuts that the tokenizer's pattern makes there
PLAIN = re.compile("[\t-\r !-~À-ÖØ-öø-ÿ]*").fullmatch
PARTS = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-zß-öø-ÿ0-9]+")
# Fixed values of byte-level tokenizers: these bytes stand for themselves, the others for the signs from U+0100 on
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(SHOWN)))}
_WORKER: dict = {}


class WordEncoder:
    """ids of a text by the tokenizers library, through the pieces it is made of.

    Only for tokenizers that lower the case, drop white space and cut at the borders of letters, digits and signs
    before they merge, so that no token crosses these. A plain text is cut into its parts here, and the library's
    model encodes each part once. Other texts are cut into words; those beyond Latin-1 letters or with a special
    token go to the library whole, a special token between them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given each core its task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        special = self.tokenizer.get_added_tokens_decoder()
        self.fence, token = next(iter(sorted(special.items())))
        self.fence_text = token.content
        self.special = [t.content for t in special.values()]
        self.cache = PieceCache(self._encode_pieces, limit=PIECES_KEPT)

    def _is_plain(self, text: str) -> bool:
        return PLAIN(text) is not None and not ("<" in text and any(x.lower() in text.lower() for x in self.special))

    def _between_fences(self, pieces: list[str]) -> list[list[int]]:
        found = []
        for start in range(0, len(pieces), 200):
            some = pieces[start : start + 200]
            one = self.tokenizer.encode(f" {self.fence_text} ".join(some), add_special_tokens=False).ids
            ends = [i for i, x in enumerate(one) if x == self.fence]
            found += [one[a + 1 : b] for a, b in zip([-1, *ends], [*ends, len(one)], strict=True)]
        return found

    def _encode_part(self, part: str) -> list[int]:
        signs = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_SIGNS)
        return [token.id for token in self.model.tokenize(signs)]

    def _encode_word(self, word: str) -> list[int]:
        if self._is_plain(word):
            return [i for part in PARTS.findall(word.lower()) for i in self._encode_part(part)]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _encode_pieces(self, pieces: list[str | bytes]) -> list[list[int]]:
        """Parts of plain texts (str) and words of others (bytes)."""
        words = [p.decode("utf-8", "replace") for p in pieces if isinstance(p, bytes)]
        odd = [w for w in words if not PLAIN(w) and self.fence_text not in w]
        fenced = dict(zip(odd, self._between_fences(odd), strict=True))
        of_words = iter([fenced[w] if w in fenced else self._encode_word(w) for w in words])
        return [next(of_words) if isinstance(p, bytes) else self._encode_part(p) for p in pieces]

    def _pieces(self, text: bytes) -> list[str] | list[bytes]:
        shown = text.decode("utf-8", "replace")
        if self._is_plain(shown):
            return PARTS.findall(shown.lower())
        # lower-casing letters of ASCII first only makes words alike that the tokenizer would make alike, but for
        # the strings of special tokens
        lowered = text.lower()
        return (text if any(x.lower().encode() in lowered for x in self.special) else lowered).split()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        with uncollected():
            split = [self._pieces(t) for t in texts]
            places = self.cache.places(list(chain.from_iterable(split)))
        ids, lengths = self.cache.expand(places)
        return ids, sums_by_row(lengths, np.fromiter(map(len, split), np.int64, len(split)))


def _encoder(path: str) -> WordEncoder:
    if path not in _WORKER:
        _WORKER[path] = WordEncoder(path)
    return _WORKER[path]


def _encode(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = _encoder(path), 0
        part = TaskContext.get().partitionId()
        for batch in slices(batches):
            ids, counts = encoder.encode(batch.column("text").to_pylist())
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), np.int32(end_id))
                counts = counts + 1
            ends = np.cumsum(counts)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.full(len(counts), part, np.int32)), pa.array(before + ends - counts), pa.array(counts, pa.int32()), lists],
                ["id", "part", "local_start", "n_tokens", "ids"],
            )
            before += int(ends[-1])

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = 1, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encodes every whole text and writes the files, ascending in id over and within the files.

    Null and empty texts hold the end id alone; rows without an id come first; rows of equal id stand side by
    side, in a fixed order; further columns are left out. An empty table gives a folder with the schema alone.
    Only whole rows are moved, by ranges of the id, and encoded where they are sorted.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("tie"), text_bytes(text_column).alias("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    kind = docs.schema[id_column].dataType.simpleString()
    coded = ordered.mapInArrow(_encode(tokenizer_path, end_id), f"id {kind}, {FILE_SCHEMA}")
    (
        coded.write.option("compression", "zstd")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, ids: list | None = None) -> DataFrame:
    """Token lists, of some ids if given; only their pages are read."""
    rows = spark.read.parquet(path)
    return rows if ids is None else rows.where(F.col("id").isin(ids))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """id, n_tokens and start: the tokens of all documents before. Doesn't touch the token lists."""
    rows = spark.read.parquet(path).select("id", "part", "local_start", "n_tokens")
    return _with_start(rows, rows).drop("part", "local_start")


def _with_start(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """start for rows with part and local_start: one sum per part, then a running sum over the parts."""
    sums = counts.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("part_tokens").over(earlier), F.lit(0)).alias("part_start"))
    return rows.join(offsets, "part").withColumn("start", F.col("part_start") + F.col("local_start")).drop("part_start")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = np.asarray(lists.offsets)
        values = np.ascontiguousarray(np.asarray(lists.values), dtype="<u4")
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        counts = np.diff(offsets).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("part"), batch.column("local_start"), pa.array(counts), pa.array(crc, pa.int64())],
            ["id", "part", "local_start", "n_tokens", "ids_crc32"],
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: id, start, n_tokens and the crc32 of its ids as little-endian 32-bit numbers."""
    rows = spark.read.parquet(path)
    kind = rows.schema["id"].dataType.simpleString()
    digests = rows.select("id", "part", "local_start", "ids").mapInArrow(_crc, f"id {kind}, part int, local_start long, n_tokens long, ids_crc32 long")
    return _with_start(digests, rows).select("id", "start", "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_digests(spark, path).withColumnRenamed("id", "doc_id")
