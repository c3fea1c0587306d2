"""Operator 13: fill-in-the-middle, cut by code points over an index of the exceptions.

Most bytes are characters. What is not is written down: for each character of several bytes the byte it starts at,
and how many bytes it has beyond one, summed up over a row of texts. Between two such exceptions code points and
bytes advance together, so a cut in code points becomes one in bytes (and back) by one search in that list and one
addition. No text is decoded, and the index grows with the exceptions only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import joined_bytes, slices, table, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE = 90  # of a hundred texts that are cut
SUFFIX_FIRST = 20  # of a hundred cut texts that begin with the suffix
SEED = 1


class Exceptions:
    """Characters of several bytes in texts that stand one after another.

    A byte 80 to BF belongs to the character before it, unless it is the first of a text; so any bytes have
    characters, and those of UTF-8 are its code points.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        follows = (data & 0xC0) == 0x80
        follows[bounds[:-1][bounds[:-1] < bounds[1:]]] = False
        at = np.flatnonzero(follows)
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        self.byte = at[first] - 1
        self.excess = np.concatenate([[0], np.cumsum(np.diff(first, append=len(at)))])
        self.char = self.byte - self.excess[:-1]

    def chars_before(self, byte: np.ndarray) -> np.ndarray:
        return byte - self.excess[np.searchsorted(self.byte, byte)]

    def bytes_before(self, char: np.ndarray) -> np.ndarray:
        return char + self.excess[np.searchsorted(self.char, char)]


def _cut(rate: int, suffix_first: int):
    prefix_mark, suffix_mark, middle_mark = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            data, bounds = joined_bytes(batch.column("text"))
            index = Exceptions(data, bounds)
            h = [np.asarray(batch.column(f"h{i}")) for i in (1, 2, 3, 4)]
            begin = index.chars_before(bounds)
            n = np.diff(begin)
            one, two = h[0] % (n + 1), h[1] % (n + 1)
            low, high = np.minimum(one, two), np.maximum(one, two)
            marked = np.array([any(m in t for m in (prefix_mark, suffix_mark, middle_mark)) for t in texts], bool)
            plain = (n == 0) | marked | (h[2] % 100 >= rate)
            swapped = h[3] % 100 < suffix_first
            ends = [index.bytes_before(begin[:-1] + cut) - bounds[:-1] for cut in (low, high)]
            out = []
            for text, a, b, whole, spm in zip(texts, *(x.tolist() for x in (*ends, plain, swapped)), strict=True):
                if whole:
                    out.append(text)
                elif spm:
                    out.append(b"".join((suffix_mark, text[b:], prefix_mark, text[:a], middle_mark, text[a:b])))
                else:
                    out.append(b"".join((prefix_mark, text[:a], suffix_mark, text[b:], middle_mark, text[a:b])))
            columns = [
                batch.column("id"), pa.array(n), pa.array(np.where(plain, "plain", np.where(swapped, "spm", "psm"))),
                pa.array(low, mask=plain), pa.array(high - low, mask=plain), pa.array(out, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """id, n, form, prefix_chars, middle_chars and output of every row; every text is read where it lies.

    n counts code points. A digest of the seed and the id draws two cuts, whether a text is cut at all (`rate` of
    a hundred) and whether the suffix comes first (`suffix_first` of a hundred); so a row gives the same in every
    run, and rows of equal id the same cuts. Null and empty texts and those that hold a mark are plain: the output
    is the text (empty for null), prefix_chars and middle_chars are null. A null id counts as an empty one.
    Repeated rows give a row each; further columns are left out; an empty table gives an empty result. Bytes that
    are no UTF-8 stay as they are.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col(id_column).alias("id"), *drawn, text_bytes(text_column).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    found = rows.mapInArrow(_cut(rate, suffix_first), f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return found.withColumn("output", F.col("output").cast("string"))


def restored(output: F.Column, form: F.Column) -> F.Column:
    """The text that an output of this form was made of. No mark is inside a part, nor can it arise at a seam."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)

    def parts(first: str, second: str) -> tuple[F.Column, F.Column]:
        return F.substring_index(F.substring_index(head, second, 1), first, -1), F.substring_index(head, second, -1)

    prefix, suffix = parts(PREFIX, SUFFIX)
    late_suffix, late_prefix = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(late_prefix, middle, late_suffix)).otherwise(output)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents")).withColumn("restored", restored(F.col("output"), F.col("form")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return cut.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLE = f"""
with drawn as (
  select doc_id, coalesce(text, '') t, sha256('{SEED}:' || coalesce(cast(doc_id as varchar), '')) h from documents
), numbers as (
  select doc_id, t, cast(length(t) as bigint) n, cast('0x' || substr(h, 1, 8) as bigint) h1, cast('0x' || substr(h, 9, 8) as bigint) h2,
    cast('0x' || substr(h, 17, 8) as bigint) h3, cast('0x' || substr(h, 25, 8) as bigint) h4
  from drawn
), cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
    case when n = 0 or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}') or h3 % 100 >= {RATE} then 'plain'
      when h4 % 100 < {SUFFIX_FIRST} then 'spm' else 'psm' end form
  from numbers
), parts as (
  select *, substring(t, 1, a) p, substring(t, a + 1, b - a) m, substring(t, b + 1, n - b) s from cuts
)
select doc_id, n, form, case when form <> 'plain' then a end prefix_chars, case when form <> 'plain' then b - a end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    else '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m end) output_sha256,
  sha256(t) restored_sha256
from parts"""
