"""Operator 9: substring dedup on bytes by anchor hashing, in place of bucket-pointer refinement.

Every place has an identifier of its next 32 bytes, made from those of 8 and 16 bytes by digests of pairs, so it is
the same in every task. No buckets are sorted or refined in rounds. Of the places in a window of 200 bytes, the one
that is least by its identifier among 169 neighbours is the window's anchor, which its bytes alone decide. Windows
are named by digests of 64, 128 and 200 bytes when anchors are found, before it is known whether an anchor is met
more than once; what repeats is then settled around anchors (see `windows`).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from punctual.llm.common import joined_bytes, mix, stored, table
from punctual.llm.windows import POSITION_BITS, Scanned, covered, cut_texts, gaps_of, keyed_texts, range_minimum, repeated_windows, span_lists

WINDOW = 200
Q = 32


def _scan(column: pa.Array) -> Scanned:
    data, bounds = joined_bytes(column)
    n = len(data)
    padded = np.zeros(n + WINDOW + Q, np.uint8)
    padded[:n] = data
    bucket = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view(">u8").ravel().astype(np.uint64)
    for offset in (8, 16):
        bucket = mix(bucket[:-offset], bucket[offset:])
    pointers = bucket  # identifiers of 32 bytes

    def at_128(places: np.ndarray) -> np.ndarray:
        at_64 = [mix(pointers[p], pointers[p + Q]) for p in (places, places + 2 * Q)]
        return mix(*at_64)

    def at_200(places: np.ndarray) -> np.ndarray:
        return mix(at_128(places), at_128(places + 72))

    def anchors() -> tuple[np.ndarray, np.ndarray]:
        here = np.arange(len(pointers), dtype=np.uint64)
        ranked = (pointers & ~np.uint64((1 << POSITION_BITS) - 1)) | here
        least = range_minimum(ranked, WINDOW - Q + 1)
        anchor = (least & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
        return anchor, pointers[anchor]

    return Scanned(bounds, WINDOW, anchors, at_200)


def _make_scan():
    return _scan


def _found(docs: DataFrame, id_column: str, text_column: str, *more: str) -> tuple[DataFrame, DataFrame]:
    texts = keyed_texts(docs, id_column, text_column, *more)
    gaps = stored(gaps_of(texts, _make_scan), "byte-gaps")
    return texts, repeated_windows(gaps, texts, _make_scan, earlier=False)


def _digests(batch: pa.RecordBatch) -> list[pa.Array]:
    sizes, removed, runs, digests = [], [], [], []
    for text, spans in zip(batch.column("text").to_pylist(), span_lists(batch), strict=True):
        gone = covered(len(text), spans, WINDOW)
        sizes.append(len(text))
        removed.append(int(gone.sum()))
        runs.append(int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0])))
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text
        digests.append(hashlib.sha256(kept).hexdigest())
    return [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string())]


def repeat_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row, without the bytes of repeated 200-byte strings.

    A byte goes if a 200-byte string that covers it also starts anywhere else, in the same row or another; all
    occurrences go, the first included. Repeated rows are rows of their own, so their texts go in each. Null
    and empty texts have no bytes; texts under 200 bytes stay; null ids make no difference; further columns
    are left out; an empty table gives an empty result.
    """
    texts, spans = _found(docs, id_column, text_column)
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return cut_texts(texts, spans, _digests, ["n_bytes", "n_removed", "n_spans", "kept_sha256"], schema)


def _kept(batch: pa.RecordBatch) -> list[pa.Array]:
    out = []
    for text, spans in zip(batch.column("text").to_pylist(), span_lists(batch), strict=True):
        if spans:
            text = np.frombuffer(text, np.uint8)[~covered(len(text), spans, WINDOW)].tobytes()
        out.append(text.decode("utf-8", "ignore"))
    return [pa.array(out, pa.string())]


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows and columns of docs, the texts without repeated 200-byte strings; a null text becomes empty.

    A character that is cut in two goes whole.
    """
    from pyspark.sql import functions as F

    inner = ("doc", "key", "id", "text", "spans")
    others = [c for c in docs.columns if c not in (id_column, text_column)]
    safe = {c: f"_{i}_{c}" if c in inner else c for i, c in enumerate(others)}
    renamed = docs.withColumnsRenamed({c: s for c, s in safe.items() if c != s})
    texts, spans = _found(renamed, id_column, text_column, *safe.values())
    cut = cut_texts(texts, spans, _kept, ["kept"], "kept string", *safe.values())
    return cut.select(*(F.col("id" if c == id_column else "kept" if c == text_column else safe[c]).alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


ORACLE = f"""
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as t from documents),
chunks as (select doc_id, c, substr(t, 400 * c + 1, {400 + 2 * WINDOW}) as s from (
    select doc_id, t, unnest(range((length(t) + 399) // 400)) as c from texts)),
places as (select doc_id, c, s, unnest(range(least(200, length(s) // 2))) as i from chunks),
windows as (select doc_id, 200 * c + i as pos, substr(s, 2 * i + 1, 2) as byte,
    case when 2 * i + {2 * WINDOW} <= length(s) then md5(substr(s, 2 * i + 1, {2 * WINDOW})) end as h from places),
repeated as (select h from windows where h is not null group by h having count(*) > 1),
marked as (select w.doc_id, w.pos, w.byte, max(cast(r.h is not null as int)) over (
    partition by w.doc_id order by w.pos rows between {WINDOW - 1} preceding and current row) as gone
    from windows w left join repeated r on r.h = w.h),
runs as (select *, case when gone = 1 and coalesce(lag(gone) over (partition by doc_id order by pos), 0) = 0 then 1 else 0 end as begins from marked)
select d.doc_id, count(m.pos) as n_bytes, cast(coalesce(sum(m.gone), 0) as bigint) as n_removed, cast(coalesce(sum(m.begins), 0) as bigint) as n_spans,
    sha256(unhex(coalesce(string_agg(m.byte, '' order by m.pos) filter (where m.gone = 0), ''))) as kept_sha256
from documents d left join runs m using (doc_id) group by d.doc_id
"""
