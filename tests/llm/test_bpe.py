"""Byte-level BPE against the tiktoken library, whole texts at once."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tagloom.llm import bpe

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(bpe.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def texts():
    rng = random.Random(5)
    words = ["the", "L'été", "don't", "we'll", "日本語", "naïve", "12345", "...", "\t", "\n\n", "   ", "x" * 90, "<|endoftext|>", "😀"]
    out = ["", " ", None, "a", "'s", "word" * 400, " " * 900 + "x", "字" * 700, "a b c" * 90, "é" * 500 + " end"]
    for n in (3, 40, 300, 1500):
        out += ["".join(rng.choice(words) + rng.choice(["", " ", "  ", "\n"]) for _ in range(n)) for _ in range(6)]
    return out


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (50, 49), (256, 8), (1 << 15, 1 << 10)])
def test_stitched_ids_equal_whole_text(spark, library, chunk, overlap):
    given = texts() + texts()[-1:]  # a repeated row, too
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(given)], "doc_id long, text string, ids string")
    tok = bpe.Tokenizer(spark)
    got = bpe.decode(bpe.encode(docs, tok, chunk=chunk, overlap=overlap), tok).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(given)))
    for r in got:
        whole = given[r.doc_id] or ""
        assert bytes(r.ids) == packed(library.encode_ordinary(whole)), r.doc_id
        assert bytes(r.raw) == whole.encode()


def test_very_long_blanks(spark):
    codec = bpe.Tokenizer(spark).codec()()
    text = "a" + " " * 250_000 + "b"
    ids = codec.ids(text)
    assert codec.raw(ids) == text.encode() and ids == packed(bpe_direct(codec, text))


def bpe_direct(codec, text):
    return [i for m in codec.pattern.finditer(text) for i in codec.encode_one()(m[0])]


def test_query_over_documents(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in bpe.op1_byte_bpe(spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text)
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_empty_table_and_null_id(spark):
    tok = bpe.Tokenizer(spark)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(empty, tok).collect() == []
    row = bpe.digests(spark.createDataFrame([(None, None)], "doc_id long, text string"), tok).first()
    assert row.n_tokens == 0 and row.ids_sha256 == row.decoded_sha256 == hashlib.sha256(b"").hexdigest()
