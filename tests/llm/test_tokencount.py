from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, empty
from vintagelens.llm import tokencount
from vintagelens.llm.common import prepare

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a", "B", "z", "1", "٣", " ", " ", "\t", "\n", "\x0b", "\x1c", "\x85", " ", " ", "́", "̈", "é", "e", "Σ", "İ", "ß",
    "'s", "'RE", "'", "中", "😀", "!", "<|endoftext|>", "<|startoftext|>", "<|END", "<|", "|>", "﻿", "‍", "\x00", "\x7f", "ﬁ", " ",
]


def expected(texts):
    library = Tokenizer.from_file(PATH)
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def found(df, **options):
    return [tuple(r) for r in tokencount.count(df, PATH, **options).collect()]


def test_equals_the_library_on_awkward_rows(spark):
    df = awkward(prepare(spark))
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    counts = expected([t for _, t in rows])
    wanted = [(k, len((t or "").encode()), n, n > 2048) for (k, t), n in zip(rows, counts, strict=True)]
    assert sorted(found(df), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("chunk_chars, part_words", [(1, 60), (200, 30), (1 << 20, 500_000)])
def test_equals_the_library_on_random_texts(spark, chunk_chars, part_words):
    prepare(spark)
    draw = random.Random(chunk_chars)
    texts = ["".join(draw.choices(ODD, k=draw.randint(0, 25))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {k: n for k, _, n, _ in found(df, chunk_chars=chunk_chars, part_words=part_words)}
    assert [got[i] for i in range(len(texts))] == expected(texts)


def test_limit_and_empty_table(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, "a b c"), (2, "a b")], "doc_id long, text string")
    assert sorted(found(df, limit=2)) == [(1, 5, 3, True), (2, 3, 2, False)]
    assert found(empty(spark)) == []


def test_a_tokenizer_that_keeps_white_space_is_refused(spark):
    with pytest.raises(ValueError, match="white space"):
        tokencount.count(awkward(prepare(spark)), public_tokenizers.path("byte_bpe_50k.json"))


def test_query_equals_the_library(spark, sf_dir):
    from vintagelens.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.n_tokens for r in QUERIES["op11_token_counts"](spark, sf_dir).collect()}
    assert got == dict(zip([k for k, _ in docs], expected([t for _, t in docs]), strict=True))
