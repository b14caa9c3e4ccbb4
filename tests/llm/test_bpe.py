"""Tree-reduced BPE against the tiktoken library and exact round trips."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CODEC = bpe.Codec.load(PATH, public_tokenizers.PATTERN)
with open(PATH, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
WANT = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

PARTS = st.sampled_from(["a", "the", "ing", " ", "  ", "\n", "\t", "'", "'s", "'re", "'l", "l", "7", "42", "!!", ".",
                         "é", "ñ", "ß", "日本", "🙂", " ", "\r\n", "tion", "zzzz", "x"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=60))
def test_small_leaves_equal_the_library(parts):
    text = "".join(parts)
    bpe.LEAF_CHARS, bpe.LEAF_BYTES = 3, 4
    try:
        fresh = bpe.Codec(RANKS, public_tokenizers.PATTERN)
        ids = fresh.encode(text)
    finally:
        bpe.LEAF_CHARS, bpe.LEAF_BYTES = 4096, 64
    assert ids == WANT.encode_ordinary(text)
    assert fresh.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text_equals_the_library(text):
    assert CODEC.encode(text) == WANT.encode_ordinary(text)


@pytest.mark.parametrize("text", ["", " " * 9000, "ab" * 7000, "a" * 9001, "ñandú" * 3000, "x\n" * 6000,
                                  "word " * 5000 + "'re" * 3000, "9" * 5000 + "é" * 5000])
def test_very_long_runs(text):
    ids = CODEC.encode(text)
    assert ids == WANT.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=400), st.binary(max_size=400))
def test_join_is_the_product_of_the_monoid(a, b):
    assert CODEC.join_ids(CODEC.merge(a) if a else [], CODEC.merge(b) if b else []) == (
        CODEC.merge(a + b) if a + b else [])
    if a:
        assert CODEC._merge_by_heap(a) == WANT._core_bpe.encode_single_piece(a)


def test_documents_with_nulls_ties_and_clashing_names(spark):
    rows = [(1, "Hello, wörld", 9), (2, None, 9), (3, "", 9), (None, "x" * 5000, 9), (1, "Hello, wörld", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    enc = bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN)
    got = sorted(((r.doc_id or 0, list(r.ids)) for r in enc.collect()))
    assert got == sorted((i or 0, WANT.encode_ordinary(t or "")) for i, t, _ in rows)
    back = {r.doc_id: bytes(r.data) for r in bpe.decode_documents(enc, PATH, public_tokenizers.PATTERN).collect()}
    assert back[None] == b"x" * 5000 and back[1].decode() == "Hello, wörld" and back[2] == b""
    digests = bpe.round_trip_digests(docs, PATH, public_tokenizers.PATTERN)
    for r in digests.collect():
        text = {1: "Hello, wörld", 2: "", 3: "", None: "x" * 5000}[r.doc_id]
        ids = WANT.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    empty = bpe.round_trip_digests(docs.where(F.lit(False)), PATH, public_tokenizers.PATTERN)
    assert empty.count() == 0
