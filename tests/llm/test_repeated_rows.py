import random
import re

import pytest

from punctual.llm import recompression, suffix_dedup, windows
from test_dedup import bytes_without_repeats, words_without_repeats


@pytest.mark.parametrize("together", [16_384, 1])
@pytest.mark.parametrize("operator", ["bytes", "words"])
def test_repeated_rows_bring_one_body_for_each_class(documents, monkeypatch, tmp_path, operator, together):
    source = random.Random(21)
    text = lambda n: " ".join(f"w{source.randrange(500)}" for _ in range(n))
    passage, copies = text(120), 60
    rows = [(1, text(30) + " " + passage + " " + text(30))] * copies
    rows += [(i, f"{text(20)} {' '.join(passage.split()[i:])} {text(20)}") for i in range(2, 8)]
    bodies = windows._bodies

    def counted(make_scan, limit):
        inner, folder = bodies(make_scan, limit), str(tmp_path)

        def run(batches):
            import uuid

            for batch in inner(batches):
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                    out.write(str(batch.num_rows))
                yield batch

        return run

    monkeypatch.setattr(windows, "_bodies", counted)
    monkeypatch.setattr(windows, "CLASSES_TOGETHER", together)
    if operator == "bytes":
        got = sorted((str(r.id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeat_digests(documents(rows)).collect())
        assert got == bytes_without_repeats(rows)
    else:
        got = sorted((str(r.id), r.n_words, r.n_removed, r.kept_sha256) for r in recompression.repeat_digests(documents(rows)).collect())
        assert got == words_without_repeats(rows)
    total = sum(int(p.read_text()) for p in tmp_path.iterdir())
    assert 0 < total < 20 * copies


def test_texts_are_dealt_out_once(documents):
    source = random.Random(4)
    text = lambda n: " ".join(f"w{source.randrange(500)}" for _ in range(n))
    passage = text(120).split()
    rows = [(i, f"{text(20)} {' '.join(passage[i:])} {text(20)}") for i in range(40)]
    found = suffix_dedup.repeat_digests(documents(rows))
    assert sorted((str(r.id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()) == bytes_without_repeats(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReusedExchange \[[^\]]*\btext#", plan)
