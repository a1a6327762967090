from __future__ import annotations

import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tallyspark.llm import bpe_index as bi  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return bi.Vocabulary(PATH)


def want(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    out = library.decode(ids, skip_special_tokens=False)
    return (doc_id, len(ids),
            hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
            hashlib.sha256(out.encode()).hexdigest())


def test_documents_and_edge_rows(docs, edge_docs, no_docs, library):
    for d in (docs, edge_docs):
        rows = sorted((tuple(r) for r in bi.encode_digests(d, PATH).collect()), key=str)
        assert rows == sorted((want(library, r.doc_id, r.text) for r in d.collect()), key=str)
    assert bi.encode_digests(no_docs, PATH).collect() == []


def test_random_strings(vocab, library):
    rng = random.Random(3)
    pool = ["a", "aa", "the", " the", "'s", "’s", "1", "²", "½", "\n", " ", "\t", "\x1c", " ",
            "é", "日本", "👍🏽", "<|endoftext|>", "<|endof", "!!", "###", "_", "ſ", "﻿"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["ab" * 3000, "a" * 5001, " " * 777, "<|endoftext|>" * 3]
    enc = bi.Encoder(vocab)
    mine = [memoryview(p).cast("I").tolist() for p in enc.encode(texts)]
    assert mine == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for t, p in zip(texts, enc.encode(texts), strict=True):
        assert bi.decode(vocab, p) == t


def test_every_character(vocab, library):
    texts = [chr(c) + " " + chr(c) + "1" for c in [*range(0, 0x3000), *range(0xFB00, 0x10100),
                                                   *range(0x1D400, 0x1D800)]]
    enc = bi.Encoder(vocab)
    mine = [memoryview(p).cast("I").tolist() for p in enc.encode(texts)]
    assert mine == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_cache_restarts(vocab, library, monkeypatch):
    monkeypatch.setattr(bi, "CACHE_WORDS", 5)
    monkeypatch.setattr(bi, "BATCH_BYTES", 10)
    enc = bi.Encoder(vocab)
    for text in ["alpha beta gamma delta epsilon zeta", "beta beta nothing new", "", "delta"]:
        ids = memoryview(enc.encode([text])[0]).cast("I").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_encode_documents_keeps_columns(edge_docs, no_docs, library):
    out = bi.encode_documents(edge_docs, PATH, column="score")
    assert out.columns == [*edge_docs.columns, "score_"]
    for r in out.collect():
        assert r["score_"] == library.encode(r.text or "", add_special_tokens=False).ids
    assert bi.encode_documents(no_docs, PATH).collect() == []


def test_decode_documents(spark, edge_docs, no_docs):
    encoded = bi.encode_documents(edge_docs, PATH)
    out = bi.decode_documents(encoded, PATH, column="score")
    assert out.columns == [*edge_docs.columns, "token_ids", "score_"]
    assert all(r["score_"] == (r.text or "") for r in out.collect())
    assert bi.decode_documents(bi.encode_documents(no_docs, PATH), PATH).collect() == []
    nothing = spark.createDataFrame([(None,), ([],)], "token_ids array<int>")
    assert {r.decoded_text for r in bi.decode_documents(nothing, PATH).collect()} == {None, ""}
    assert sorted(map(str, bi.verified(encoded, PATH).collect())) == sorted(
        map(str, encoded.collect()))
    wrong = spark.createDataFrame([("other text", encoded.first().token_ids)],
                                  "text string, token_ids array<int>")
    with pytest.raises(Exception, match="do not decode"):
        bi.verified(wrong, PATH).count()
