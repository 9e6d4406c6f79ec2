"""Byte-level BPE against the tiktoken library, with chunks small enough to stitch."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from epochal.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def want(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((str(doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out)


def got(df, **sizes):
    return sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df, PATH, PATTERN, **sizes).collect())


@pytest.mark.parametrize("sizes", [{}, {"chunk": 300, "overlap": 40}, {"chunk": 64, "overlap": 16}])
def test_documents(docs, library, sizes):
    assert got(docs, **sizes) == want(library, [tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("sizes", [{}, {"chunk": 200, "overlap": 50}])
def test_odd(odd, empty, library, sizes):
    assert got(odd, **sizes) == want(library, [tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert bpe.digests(empty, PATH, PATTERN, **sizes).count() == 0


def test_hard_texts(spark, library):
    """Runs without boundaries, white space at the cuts, contractions, mixed scripts."""
    rng = random.Random(6)
    texts = ["a" * 5000, " " * 777 + "x" + "\n" * 555, "it's we'll they've " * 200, "日本語テキスト" * 300, "".join(rng.choice("ab 1\n\t'é😀.,") for _ in range(4000)), "x  y   z    " * 300]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for sizes in ({}, {"chunk": 128, "overlap": 32}, {"chunk": 1000, "overlap": 100}):
        assert got(df, **sizes) == want(library, rows)


def test_long_merge():
    c = bpe.codec(PATH, PATTERN)
    rng = random.Random(1)
    for n in (257, 400):
        piece = bytes(rng.choice(b"abcdefgh") for _ in range(n))
        long = bpe.merge(piece, c.ranks)
        assert c.decode(np.array(long, "<u4").tobytes()) == piece
        assert long == tiktoken.Encoding("one", pat_str=r"[\s\S]+", mergeable_ranks=c.ranks, special_tokens={}).encode_ordinary(piece.decode())


def test_two_ranks_in_one_worker():
    """What is remembered of one file's pre-tokens is not taken for another's."""
    texts = ["the same words in both files", "naïve 12345 the"]
    other = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for path in (PATH, other, PATH):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        own = tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        codec = bpe.codec(path, PATTERN)
        assert [np.frombuffer(codec.encode(t), "<u4").tolist() for t in texts] == [own.encode_ordinary(t) for t in texts]
