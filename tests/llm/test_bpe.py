from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from tests.llm.helpers import awkward, empty
from vintagelens.llm import bpe

PARTS = ["a", "b", " ", "  ", "\n", "\t", " ", "é", "中", "'s", "'", "1", "٣", ".", ",", "\x1c", " ", "\x85", "😀", "the", "ing"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def model(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_as_the_library(spark, ranks, model):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(3_000)]
    texts += ["a" * 3_000, "ab" * 5_000, "   ", "\n\n  x", "héllo" * 2_000, "", "<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, chunk_bytes=5_000), ranks).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: model.encode_ordinary(t) for i, t in enumerate(texts)}
    assert all(bytes(r.bytes).decode() == texts[r.doc_id] for r in rows)


def test_words_join_to_the_text():
    rng = random.Random(2)
    for _ in range(2_000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20)))
        assert "".join(bpe.words_of(text)) == text


def test_awkward_rows(spark, ranks, model):
    docs = awkward(spark)
    got = Counter((r.doc_id, tuple(r.ids)) for r in bpe.encode(docs, ranks, public_tokenizers.PATTERN).collect())
    assert got == Counter((r.doc_id, tuple(model.encode_ordinary(r.text or ""))) for r in docs.collect())
    assert bpe.encode(empty(spark), ranks, public_tokenizers.PATTERN).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.bytes) for r in bpe.decode(none, ranks).collect()] == [b"", b""]
