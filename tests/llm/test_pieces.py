import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from flowquarry.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_equals_library_on_random_texts(library):
    table, rnd = pieces.PrefixTable(MODEL), random.Random(5)
    names = list(table.rank)
    for _ in range(6000):
        kind = rnd.random()
        if kind < 0.4:
            text = "".join(rnd.choice("ab e\nthin▁ \t\xa0é€😀\0") for _ in range(rnd.randint(0, 20)))
        elif kind < 0.7:
            text = "".join(rnd.choice(names) for _ in range(rnd.randint(0, 8))).replace("▁", rnd.choice([" ", "▁", "  "]))
        else:
            text = "".join(rnd.choice("aeisnt r") for _ in range(rnd.randint(0, 60)))
        ids = library.encode(text)
        assert table.encode(text) == ids
        assert table.digest(text) == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))
        assert table.decode(ids) == library.decode(ids)


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 4)
    monkeypatch.setattr(pieces, "PAIRS", 2)
    table = pieces.PrefixTable(MODEL)
    text = "the quick brown fox jumps over the lazy dog and the quick cat " * 3
    assert table.encode(text) == library.encode(text)


def test_edge_rows(spark, edge_docs, empty_docs, library):
    rows = pieces.encode_documents(edge_docs, MODEL).collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, len(library.encode(r.text or "")), digest(library.decode(library.encode(r.text or "")))) for r in edge_docs.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.decoded_sha256) for r in rows) == want
    assert pieces.encode_documents(empty_docs, MODEL).count() == 0
