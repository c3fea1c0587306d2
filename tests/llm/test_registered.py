import hashlib
import zlib

import numpy as np
import pytest

import __spark_entry__ as registered
import corpus_pipeline
from punctual.llm import queries

NAMES = ("op1_token_files op2_quality_classifier op3_recompression op4_quality_rules op5_nn_descent op6_sentencepiece "
         "op7_simhash op8_token_counts op9_suffix_dedup op10_mixing op11_hard_negatives op12_toxicity op13_fill_in_middle").split()
COLUMNS = {
    "op1_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op2_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op3_recompression": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op4_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op5_nn_descent": ["vec_id", "n_links", "component_id", "kept"],
    "op7_simhash": ["doc_id", "fingerprint", "component_id"],
    "op8_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op9_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op12_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op13_fill_in_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
}


def test_every_operator_is_registered():
    assert list(queries.QUERIES) == sorted(NAMES, key=lambda n: int(n[2:].split("_")[0]))
    assert set(registered.queries()) >= {*NAMES, "pipeline"}
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.fixture(scope="module")
def results(spark, small):
    return {name: queries.QUERIES[name](spark, small) for name in COLUMNS}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract(spark, small, results, name):
    frame = results[name]
    assert frame.columns[: len(COLUMNS[name])] == COLUMNS[name]
    rows = frame.collect()
    table = "embeddings" if name == "op5_nn_descent" else "documents"
    given = spark.read.parquet(f"{small}/{table}.parquet")
    key = COLUMNS[name][0]
    assert sorted(r[key] for r in rows) == sorted(r[0] for r in given.select(key).collect())


def test_digests_belong_to_the_texts(spark, small, results):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in results["op9_suffix_dedup"].collect():
        assert r.n_bytes == len(texts[r.doc_id])
        assert r.n_removed or r.kept_sha256 == hashlib.sha256(texts[r.doc_id]).hexdigest()
    for r in results["op3_recompression"].collect():
        assert r.n_removed or r.kept_sha256 == hashlib.sha256(b" ".join(texts[r.doc_id].split())).hexdigest()


def test_pipeline(spark, small):
    pytest.importorskip("public_tokenizers")
    from sentencepiece import SentencePieceProcessor

    docs = spark.read.parquet(f"{small}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small).cache()
        counts.append(docs.count())
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS, name
    assert counts[0] > counts[1] > counts[2] == counts[3] > 0
    library = SentencePieceProcessor(model_file=corpus_pipeline.piece_codec.model_path())
    expected = sorted((r.doc_id, zlib.crc32(np.array(library.encode(r.text), "<u4").tobytes())) for r in docs.collect())
    got = corpus_pipeline.run(spark, small).collect()
    assert sorted((r.doc_id, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got) == expected


def test_pipeline_of_nothing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert docs.count() == 0


def test_hard_negatives_of_the_given_vectors(spark, small):
    frame = queries.QUERIES["op11_hard_negatives"](spark, small)
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = frame.collect()
    assert rows and {r.anchor_id % 100 for r in rows} == {0} and max(r["rank"] for r in rows) <= 10
