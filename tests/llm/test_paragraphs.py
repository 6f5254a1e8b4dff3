from __future__ import annotations

import random

from pyspark.sql import functions as F

from vintagelens.llm import fingerprint as fp

rng = random.Random(11)


def drawn(vocabulary, n, between=" "):
    return between.join(rng.choice(vocabulary) for _ in range(n))


HAN, THAI = [chr(c) for c in range(0x4E00, 0x4E00 + 800)], [chr(c) for c in range(0x0E01, 0x0E2E)]
TEXTS = {
    "two words": drawn(["aa", "bcd"], 20_000),
    "five words": drawn(["alpha", "beta", "gamma", "delta", "eps"], 20_000),
    "tabs": drawn([f"w{i}" for i in range(300)], 3_000, "\t"),
    "lines": drawn([f"w{i}" for i in range(300)], 3_000, "\n"),
    "chinese": drawn(HAN, 20_000, ""),
    "thai": drawn(THAI, 3_000, ""),
    "letters": drawn("abcdefghijklmnopqrstuvwxyz", 5_000, ""),
    "emoji": drawn(["\U0001F600", "\U0001F601", "\U0001F680", "x"], 3_000, ""),
    "periodic": "alpha beta gamma delta " * 5_000,
    "one letter": "a" * 30_000,
}


def test_paragraphs_follow_the_text(spark):
    docs = list(enumerate(TEXTS.values()))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    names = list(TEXTS)
    for r in fp.fingerprints(df).collect():
        if names[r.doc_id] not in ("periodic", "one letter"):  # whose paragraphs are equal
            assert 5 <= len(r.digests) <= 25, (names[r.doc_id], len(r.digests))
    for r in fp.edits(df).collect():
        assert r.near_edited > 0, names[r.doc_id]


def test_words_joined_are_the_text(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS.values(), "a  b\u3000c\u00a0 d", " x", "x ", "\U0001F600" * 40]], "text string")
    assert df.where(F.array_join(fp.words(F.col("text")), "") != F.col("text")).count() == 0
    cut = spark.createDataFrame([("ab c\td\u4e2d\u6587\U0001F600e",)], "text string").select(fp.words(F.col("text"))).first()[0]
    assert cut == ["ab ", "c\t", "d\u4e2d", "\u6587", "\U0001F600", "e"]


def test_an_edit_in_front_leaves_later_paragraphs(spark):
    rows = [(k, t, "one more " + t) for k, t in TEXTS.items() if k not in ("periodic", "one letter")]
    level = fp.level(F.col("text"))
    sets = [fp.digests(fp.words(F.col(c)), level).alias(c) for c in ("text", "moved")]
    for r in spark.createDataFrame(rows, "name string, text string, moved string").select("name", *sets).collect():
        assert len(set(r.text) & set(r.moved)) >= len(r.text) / 2, r.name
