import random
import zlib

import numpy as np
import pytest

from punctual.llm import piece_codec, token_counts, token_files
from punctual.llm.common import PieceCache, new_path

ALPHABET = "aàsrvlemtdthe' \n\t.!12½日本語▁<|0xéÄßİ#$*"


def random_texts(n, seed=1):
    source = random.Random(seed)
    return ["".join(source.choice(ALPHABET) for _ in range(source.randint(0, 60))) for _ in range(n)]


def test_token_files_hold_what_the_library_gives(spark, documents, odd_rows, tokenizers_here):
    from tokenizers import Tokenizer

    path = tokenizers_here.path("word_bpe_49k.json")
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(random_texts(300))]
    files = new_path(spark, "tokens")
    token_files.write_token_files(documents(rows), files, path)
    library = Tokenizer.from_file(path)
    expected = sorted((i is not None, i or 0, tuple(library.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in rows)
    got = token_files.read_tokens(spark, files).collect()
    assert sorted((r.id is not None, r.id or 0, tuple(r.ids)) for r in got) == expected
    digests = token_files.token_digests(spark, files).collect()
    by_start = sorted(digests, key=lambda r: r.start)
    assert [(r.id is not None, r.id or 0) for r in by_start] == sorted((r.id is not None, r.id or 0) for r in by_start)
    assert [r.start for r in by_start] == np.cumsum([0, *(r.n_tokens for r in by_start)])[:-1].tolist()
    crc = {(r.id, r.n_tokens, r.ids_crc32) for r in digests}
    assert crc == {(i if known else None, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for known, i, ids in expected}
    assert [tuple(r.ids) for r in token_files.read_tokens(spark, files, [8]).collect()] == [tuple(library.encode("a", add_special_tokens=False).ids) + (1,)]
    metadata = token_files.read_metadata(spark, files)
    assert "ids" not in metadata.columns and metadata.count() == len(rows)


def test_words_and_parts_are_cut_as_the_library_cuts_them(tokenizers_here):
    from tokenizers import Tokenizer

    path = tokenizers_here.path("word_bpe_49k.json")
    pieces = ["don't", "IT'S", "''s", "!'s", "'tis", "<|ENDOFTEXT|>", "<|endoftext|>", "<|", "Été", "Ÿ", "²", " ", "\x0b", "\x1c", "\xa0", "1", "23", "a", "(x)", "--", "你好", "e\u0301", "ΣΑΣ"]
    source = random.Random(3)
    texts = ["".join(source.choice(pieces[:n]) for _ in range(source.randint(0, 20))) for n in (5, 10, 18, len(pieces)) for _ in range(400)]
    library = Tokenizer.from_file(path)
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    ids, counts = token_files.WordEncoder(path).encode([t.encode() for t in texts])
    ends = np.cumsum(counts)
    assert [ids[a:b].tolist() for a, b in zip(ends - counts, ends, strict=True)] == expected


def test_selective_reads_leave_the_lists_alone(spark, documents, tokenizers_here):
    files = new_path(spark, "tokens")
    token_files.write_token_files(documents([(i, f"text {i}") for i in range(50)]), files, tokenizers_here.path("word_bpe_49k.json"))
    plan = token_files.read_metadata(spark, files)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1]
    assert "PushedFilters: [In(id" in token_files.read_tokens(spark, files, [3, 4])._jdf.queryExecution().executedPlan().toString()


def test_token_files_of_an_empty_table(spark, documents, tokenizers_here):
    files = new_path(spark, "tokens")
    token_files.write_token_files(documents([]), files, tokenizers_here.path("word_bpe_49k.json"))
    assert token_files.token_digests(spark, files).count() == 0


def test_counts_equal_the_library(documents, odd_rows, tokenizers_here):
    from tokenizers import Tokenizer

    path = tokenizers_here.path("byte_bpe_50k.json")
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(random_texts(300, 2))]
    library = Tokenizer.from_file(path)
    expected = sorted((i is not None, i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    got = token_counts.token_counts(documents(rows), path).collect()
    assert sorted((r.id is not None, r.id or 0, r.n_bytes, r.n_tokens) for r in got) == expected
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert token_counts.token_counts(documents([]), path).count() == 0


@pytest.mark.parametrize("chunk", [1, 3, 128])
def test_state_maps_compose(chunk):
    splitter = token_counts.PieceSplitter()
    text = "it's 'twas  they've\n\n ''re x'r 12½ " * 20
    points = np.frombuffer((text).encode("utf-32-le"), np.uint32)
    points = np.concatenate([points, [0x110000], points[7:]]).astype(np.uint32)
    assert (splitter.begins(points, chunk) == splitter.begins(points, len(points))).all()


def test_pieces_are_the_librarys(tokenizers_here):
    from tokenizers.pre_tokenizers import ByteLevel

    splitter = token_counts.PieceSplitter()
    for text in random_texts(300, 3):
        if text:
            points = np.append(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.uint32(0x110000))
            begins = np.flatnonzero(splitter.begins(points)).tolist()
            assert begins == [span[0] for _, span in ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)]


def test_sentencepiece_equals_the_library_both_ways(documents, odd_rows, tokenizers_here):
    from sentencepiece import SentencePieceProcessor

    path = piece_codec.model_path()
    library = SentencePieceProcessor(model_file=path)
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(random_texts(300, 4))]
    encoded = piece_codec.encode(documents(rows), path)
    got = sorted((r.id is not None, r.id or 0, tuple(r.ids)) for r in encoded.collect())
    assert got == sorted((i is not None, i or 0, tuple(library.encode(t or ""))) for i, t in rows)
    back = sorted((r.id is not None, r.id or 0, r.text) for r in piece_codec.decode(encoded, path).collect())
    assert back == sorted((i is not None, i or 0, library.decode(library.encode(t or ""))) for i, t in rows)
    for r in piece_codec.digests(documents([(1, "a  b\n c"), (2, "▁")]), path).collect():
        assert r.round_trip == (r.id == 1)
    assert piece_codec.encode(documents([]), path).count() == 0


def test_every_occurrence_of_a_piece_is_an_edge(tokenizers_here):
    codec = piece_codec.PieceCodec(piece_codec.model_path())
    text = "▁the▁theme▁of▁them\x00▁日本"
    starts, ends, pieces = codec.edges(text)
    found = {(a, b, codec.pieces[p]) for a, b, p in zip(starts.tolist(), ends.tolist(), pieces.tolist(), strict=True)}
    assert found == {(i, i + len(p), p) for p in codec.pieces for i in range(len(text)) if text.startswith(p, i)}


def test_a_piece_is_looked_up_once():
    """Each occurrence asks for the hash of its piece once, however it is met: anew, again, or in the generation before."""

    class Piece(str):
        asked = 0

        def __hash__(self):
            Piece.asked += 1
            return super().__hash__()

    computed = []
    cache = PieceCache(lambda pieces: computed.append(list(pieces)) or [[len(p)] * len(p) for p in pieces], limit=3)
    for texts in (["a", "bb", "a", "bb", "ccc", "dddd"], ["bb", "eeeee", "bb", "a", ""], ["x"] * 50):
        places = cache.places([Piece(t) for t in texts])
        ids, lengths = cache.expand(places)
        assert lengths.tolist() == [len(t) for t in texts]
        assert ids.tolist() == [len(t) for t in texts for _ in t]
    assert computed == [["a", "bb", "ccc", "dddd"], ["eeeee", ""], ["x"]]
    # 61 occurrences; a new piece is looked up, set and, after the first generation, looked for in the one before
    assert Piece.asked <= 61 + 2 * 9
