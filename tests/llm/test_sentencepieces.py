"""Piece encoding against the library, and round trips."""

from __future__ import annotations

import zlib

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lettermill.llm import sentencepieces as sp

PATH = P.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ALPHABET = st.sampled_from(list("abcdehinorst  \n\t.,'1é漢😀▁\u0000<>"))


def ours(texts):
    return [x.tolist() for x in sp.Encoder(sp.pieces_of(PATH)).encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60) | st.text(max_size=20), max_size=5))
def test_ids_equal_the_library(texts):
    assert ours(texts) == [LIBRARY.encode(t) for t in texts]


def test_real_texts_equal_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    encoded = sp.encode_documents(docs, PATH)
    for r in encoded.collect():
        ids = LIBRARY.encode(texts[r["doc_id"]])
        assert r["n_ids"] == len(ids) and r["lossless"]
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    assert {r["doc_id"]: r["text"] for r in sp.decode_documents(encoded, PATH).collect()} == texts


@pytest.mark.parametrize("text", ["a" * 3000, "the" * 700, " " * 500 + "x" + " " * 333, "abcdefgh" * 300, "\n" * 400, "1234567890" * 100])
def test_long_runs_equal_the_library(text):
    assert ours([text, "x " + text]) == [LIBRARY.encode(text), LIBRARY.encode("x " + text)]


def test_small_batches_and_forgotten_words(monkeypatch):
    monkeypatch.setattr(sp, "FLUSH_CHARS", 5)
    monkeypatch.setattr(sp, "KNOWN_WORDS", 3)
    texts = ["the quick brown fox", "jumps over", "", "the lazy dog é"]
    encoder = sp.Encoder(sp.pieces_of(PATH))
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode(texts)] == [LIBRARY.encode(t) for t in texts]


def test_odd_rows(spark):
    schema = "doc_id long, text string, ids string"
    df = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (None, "a▁b", "z"), (3, "x", "z"), (3, "x", "z")], schema)
    got = sorted((r["doc_id"] or 0, r["n_ids"], r["lossless"]) for r in sp.encode_documents(df, PATH).collect())
    assert got == [(0, 2, True), (1, 0, True), (2, 0, True), (3, 1, True), (3, 1, True)]
    assert sp.encode_documents(df.limit(0), PATH).count() == 0
