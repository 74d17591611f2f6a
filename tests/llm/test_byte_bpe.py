"""Operator 1 against the tiktoken library."""

import hashlib
import random

import numpy as np
import pytest

from termscope.llm import byte_bpe

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
SCHEMA = "doc_id long, text string, ids string, n_tokens int"
ALPHABET = ["a", "b", "the", "ing", " ", "  ", "\n", "\r\n", "'", "'re", "'ll", "r", "e", "l", "é", "ß", "1", "23", "!", "...", "\xa0",
            "　", "😀", "한", "́", "'s", "\x1c", "A", "Z", "ab", "\x85", "​", "<|endoftext|>"]


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("leaf_chars,leaf_bytes,leaf_ids", [(1, 1, 1), (2, 3, 2), (5, 2, 7), (50, 8, 3), (4096, 24, 8192)])
def test_trees_of_any_leaf_size(ranks, reference, leaf_chars, leaf_bytes, leaf_ids):
    codec = byte_bpe.BytePairCodec(ranks, P.PATTERN, leaf_chars, leaf_bytes, leaf_ids, cache=50)
    rng = random.Random(leaf_chars)
    for _ in range(600):
        text = "".join(rng.choices(ALPHABET, k=rng.choice([0, 1, 3, 10, 40, 200])))
        ids = np.frombuffer(codec.encode(text), "<u4")
        assert ids.tolist() == reference.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 9000, " " * 9000, "ab" * 9000, "\n" * 9000, "x" * 300 + " " * 300 + "é" * 3000, "!?" * 4000])
def test_long_pieces(ranks, reference, text):
    codec = byte_bpe.BytePairCodec(ranks, P.PATTERN)
    ids = np.frombuffer(codec.encode(text), "<u4")
    assert ids.tolist() == reference.encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_every_pair_of_an_encoding_is_an_encoding(ranks):
    """The ground of the joins: adjacent tokens encode to themselves, and tokens alone too."""
    codec = byte_bpe.BytePairCodec(ranks, P.PATTERN)
    rng = random.Random(5)
    for token in rng.sample(list(ranks), 3000):
        assert codec.merge(token) == [token]
    for _ in range(500):
        tokens = codec.merge(bytes(rng.choices(b"abething 'lr", k=60)))
        assert all(codec.merge(a + b) == [a, b] for a, b in zip(tokens, tokens[1:]))


def test_query_columns(spark, reference):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randrange(400))) for _ in range(60)] + [None, "", "word " * 50_000]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "a b", None, None), (0, texts[0], "x", 1)]
    got = byte_bpe.digests(byte_bpe.encode_decode(spark.createDataFrame(rows, SCHEMA), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "a b" if r.doc_id is None else texts[r.doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    assert byte_bpe.encode_decode(spark.createDataFrame([], SCHEMA), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0
