import hashlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from corpusloom.llm.bpe import ByteBpe

HARD = ["", " ", "a", "\n\n  x", "don't we'll I'M 'S", "x" * 5000, "ab" * 999, "  \t\r\n\x0b\x0c \x1c\x1d\x85  z", "a<|endoftext|> <|endoftext|>b", "<|endoftext|", "日本語テキスト 😀😀 é", "\x00\x01\x7f﻿�", "１２３ ½ Ⅷ ٣٤", "Ñllta ciónó ß straße", "a_b __ --- !!! ###"]


@pytest.fixture(scope="module")
def both():
    path = P.path("byte_bpe_50k.json")
    return ByteBpe(path), tokenizers.Tokenizer.from_file(path)


def test_like_the_library(both):
    mine, theirs = both
    rng = np.random.default_rng(7)
    random = ["".join(chr(c) for c in rng.integers(1, 0x2500, rng.integers(1, 60))) for _ in range(300)]
    texts = HARD + random
    for text, packed in zip(texts, mine.encode_packed(texts), strict=True):
        ids = np.frombuffer(packed, "<u4").tolist()
        want = theirs.encode(text, add_special_tokens=False).ids
        assert ids == want, repr(text)
        assert mine.decode_packed(packed) == theirs.decode(want, skip_special_tokens=False)


def test_cache_starts_anew(both, monkeypatch):
    import corpusloom.llm.bpe as module

    monkeypatch.setattr(module, "CACHE_ENTRIES", 3)
    mine, theirs = both
    texts = ["one two three four five", "six seven", "one"]
    assert [np.frombuffer(x, "<u4").tolist() for x in mine.encode_packed(texts)] == [theirs.encode(t, add_special_tokens=False).ids for t in texts]


def test_documents(spark, both):
    from corpusloom.llm.bpe import digests, encode_documents

    path = P.path("byte_bpe_50k.json")
    rows = [(1, None, "x"), (2, "", "y"), (3, "Hello world", "z"), (3, "Hello world", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(docs, path).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    packed = np.array(both[1].encode("Hello world", add_special_tokens=False).ids, "<u4").tobytes()
    assert got == {(1, 0, empty, empty), (2, 0, empty, empty), (3, 2, hashlib.sha256(packed).hexdigest(), hashlib.sha256(b"Hello world").hexdigest())}
    assert encode_documents(docs, path).columns == ["doc_id", "text", "ids", "decoded"]
    assert digests(docs.limit(0), path).count() == 0
