from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty
from vintagelens.llm import repeats


def brute(docs, length):
    raw = [(k, (t or "").encode()) for k, t in docs]
    seen = Counter(r[i : i + length] for _, r in raw for i in range(len(r) - length + 1))
    out = Counter()
    for k, r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out[k, len(r), runs, bytes(b for b, x in zip(r, gone, strict=True) if not x)] += 1
    return out


def found(docs, **settings):
    return Counter((r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in repeats.remove(docs, **settings).collect())


@pytest.mark.parametrize(
    ("letters", "length", "window", "gram", "classes"),
    [("ab", 20, 8, 4, 50_000), ("ab", 20, 8, 4, 3), ("a", 12, 4, 4, 100), ("abé", 24, 16, 8, 50_000)],
)
def test_as_brute_force(spark, letters, length, window, gram, classes):
    rng = random.Random(5)
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(10, 60))) for _ in range(12)]

    def piece():
        return rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice(letters + "xyz") for _ in range(rng.randint(1, 30)))

    docs = [(i, "".join(piece() for _ in range(rng.randint(0, 6)))) for i in range(150)]
    docs += [(150, None), (None, "ab" * 30), (None, "ab" * 30), (3, docs[3][1]), (3, "other" * 9)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(frame, length=length, window=window, gram=gram, group_classes=classes) == brute(docs, length)


def test_intervals_and_reaches():
    assert list(repeats.prefix_intervals(np.array([2, 1, 3]))) == [(2, 0, 1), (3, 2, 3), (1, 0, 3)]
    left, right = repeats.reaches([b"xab", b"yab", b"zzb"], [b"cde", b"cdf", b"cde"], 4)
    assert left.tolist() == [2, 2, 1] and right.tolist() == [3, 2, 3]


def test_awkward_rows(spark):
    rows = repeats.remove(awkward(spark)).collect()
    assert len(rows) == 10
    kept = {r.doc_id: bytes(r.kept) for r in rows}
    assert kept[5] == kept[6] == b"" and kept[2] == b"" and kept[7] == b"x"
    assert repeats.remove(empty(spark)).count() == 0


def brute_passages(docs, words):
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in docs]
    places = defaultdict(set)
    for (k, t), own in zip(docs, split, strict=True):
        for i in range(len(own) - words + 1):
            places[tuple(own[i : i + words])].add((k, t))
    out = Counter()
    for (k, _), own in zip(docs, split, strict=True):
        hit = [i for i in range(len(own) - words + 1) if len(places[tuple(own[i : i + words])]) > 1]
        out[k, tuple(repeats.merge_spans([(i, i + words) for i in hit]))] += 1
    return out


def found_passages(docs, **settings):
    return Counter((r.doc_id, tuple((p.start, p.end) for p in r.passages)) for r in repeats.remove(docs, **settings).collect())


@pytest.mark.parametrize(("words", "window", "gram"), [(9, 4, 2), (5, 2, 2), (12, 8, 4)])
def test_passages_as_brute_force(spark, words, window, gram):
    rng = random.Random(words)
    letters = ["a", "b", "é"]
    pool = [[rng.choice(letters) for _ in range(rng.randint(3, 30))] for _ in range(12)]

    def piece():
        if rng.random() < 0.5:
            return rng.choice(pool)
        return [rng.choice("xyz") + str(rng.randint(1, 9)) for _ in range(rng.randint(1, 12))]

    def text():
        return "".join(w + rng.choice([" ", "\n", "  "]) for _ in range(rng.randint(0, 6)) for w in piece())

    docs = [(i, text()) for i in range(150)] + [(150, None), (151, "once " * 40), (151, "once " * 40), (152, "q r " * 30)]
    docs += [(None, "s t u " * 20), (None, "s t u " * 20), (153, docs[3][1]), (3, "other words " * 9)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert found_passages(frame, words=words, word_window=window, word_gram=gram) == brute_passages(docs, words)


def test_passage_below_the_bytes_of_a_string(spark):
    rng = random.Random(2)

    def some(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))

    passage, fifty = some(51), some(50)
    docs = [(1, some(90) + " " + passage + " " + some(80)), (2, passage.replace(" ", "\n") + " " + some(70)), (3, some(200))]
    docs += [(4, some(30) + " " + fifty + " " + some(5)), (5, some(9) + " " + fifty), (6, " ".join([passage[::-1]] * 2))]
    rows = {r.doc_id: r for r in repeats.remove(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(passage) < repeats.LENGTH
    assert {k: [tuple(p) for p in r.passages] for k, r in rows.items()} == {1: [(90, 141)], 2: [(0, 51)], 3: [], 4: [], 5: [], 6: []}
    assert all(not r.removed for r in rows.values())


def moved(df):
    """What the exchanges of a plan get their rows from."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [below for line, below in zip(lines[:-1], lines[1:], strict=True) if "Exchange" in line]


def test_texts_do_not_move(spark, monkeypatch):
    rng = random.Random(3)
    pool = [" ".join(str(rng.random()) for _ in range(60)) for _ in range(4)]
    docs = [(i, f"{i} " + rng.choice(pool)[: rng.randint(300, 1100)]) for i in range(40)]
    plans, stored = [], repeats.stored

    def seen(df, *rest):
        plans.extend(moved(df))
        return stored(df, *rest)

    monkeypatch.setattr(repeats, "stored", seen)
    # Tables of this size would be broadcast, large ones are not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = repeats.remove(spark.createDataFrame(docs, "doc_id long, text string"))
        rows = out.collect()
        plans += moved(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert any(r.removed for r in rows) and any(r.passages for r in rows)
    assert len(plans) > 10 and not [x for x in plans if re.search(r"\btext#", x)]


def test_spans_over_many_chunks(spark):
    rng = random.Random(8)
    pool = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(9)]
    # More documents in a partition than a chunk has; copies under one doc_id and under none.
    docs = [(i, "".join(rng.choice([*pool, f"x{i}y"]) for _ in range(3)) if i % 7 else f"{i}z") for i in range(1300)]
    docs += [(5, docs[5][1]), (None, docs[6][1]), (None, docs[6][1]), (1300, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    settings = {"length": 70, "window": 32, "gram": 16}
    assert found(frame, **settings) == brute(docs, 70)
    spans = defaultdict(set)
    for r in repeats.repeated_spans(frame, **settings).collect():
        spans[r.doc_id, r.h].add((r.start, r.end))
    own = {(r.doc_id, r.h): r.text for r in frame.withColumn("h", F.xxhash64("text")).collect()}
    runs = Counter((k, len(own[k, h]), len(repeats.merge_spans(v))) for (k, h), v in spans.items())
    assert runs == Counter(set((k, n, m) for k, n, m, _ in brute(docs, 70) if m))
