from __future__ import annotations

import base64
import random
import struct

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty
from vintagelens.llm import fingerprint as fp


def test_peeling_recovers_the_difference(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(200):
        both = [rng.getrandbits(60) for _ in range(rng.randint(0, 20))]
        a, b = ([rng.getrandbits(60) for _ in range(rng.randint(0, 15))] for _ in range(2))
        rows.append((both + a, both + b, a, b))
    df = spark.createDataFrame(rows, "one array<long>, other array<long>, a array<long>, b array<long>")
    small = fp.peel(fp.subtract(fp.sketch(F.col("one"), 30), fp.sketch(F.col("other"), 30)), F.lit(30)).alias("small")
    found = df.select("*", fp.difference(F.col("one"), F.col("other")).alias("d"), fp.likeness(F.col("one"), F.col("other")).alias("n"), small)
    peeled = 0
    for r in found.collect():
        wanted = {(k, 1) for k in r.a} | {(k, -1) for k in r.b}
        assert {(x.k, x.n) for x in r.d} == wanted
        union = len(set(r.one) | set(r.other))
        assert abs(r.n - (len(set(r.one) & set(r.other)) / union if union else 1)) < 1e-12
        if r.small is not None:  # what one small table peels is right as well
            assert {(x.k, x.n) for x in r.small} == wanted
            peeled += 1
    assert peeled > 100


def test_edits_as_in_python(spark):
    rng = random.Random(7)
    docs = [(i, " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 300)))) for i in range(300)]
    docs += [(300, None), (301, "é😀"), (302, docs[5][1])]
    rows = {r.doc_id: r for r in fp.edits(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    order = sorted(docs, reverse=True)
    for (k, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert rows[k].edited == edited and rows[k].n_chars == len(text)
        assert 0 <= rows[k].near_next <= 1 and (edited != text or rows[k].near_edited == 1)
    assert rows[5].fingerprint == rows[302].fingerprint
    long = [r for r in rows.values() if r.n_chars > 400]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)


def test_awkward_rows(spark):
    rows = fp.edits(awkward(spark)).collect()
    assert len(rows) == 10
    assert {r.near_next for r in rows if r.doc_id == 6} >= {1.0}
    assert fp.edits(empty(spark)).count() == 0
    alone = fp.edits(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).collect()
    assert [r.edited for r in alone] == ["a b a b"]


def parsed(text):
    """Level, sizes and both tables of a returned fingerprint."""
    level, n_own, n_coarse, packed = text.split("-", 3)
    raw = base64.b64decode(packed)
    cells = [struct.unpack(">HQQ", raw[i : i + 18]) for i in range(0, len(raw), 18)]
    return int(level), int(n_own), int(n_coarse), cells[: fp.CELLS], cells[fp.CELLS :]


def peeled(one, other, placed):
    """Number of digests in one table only, by subtraction and peeling; None if that fails."""
    cells = [[a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2]] for a, b in zip(one, other, strict=True)]
    found = 0
    while True:
        pure = next((c for c in cells if abs(c[0]) == 1 and c[1] in placed and placed[c[1]][0] == c[2]), None)
        if pure is None:
            return found if all(c == [0, 0, 0] for c in cells) else None
        n, key, check = pure
        for at in placed[key][1]:
            cells[at] = [cells[at][0] - n, cells[at][1] ^ key, cells[at][2] ^ check]
        found += 1


def test_likeness_follows_from_the_returned_fingerprints(spark):
    rng = random.Random(12)
    docs = [(i, " ".join(f"w{rng.randint(0, 900)}" for _ in range(rng.choice([0, 3, 60, 200, 230, 420, 1_500])))) for i in range(160)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = fp.edits(df).orderBy(F.desc("doc_id")).collect()
    # Where a digest lies, and its check, of all digests there are, at both levels.
    texts = spark.createDataFrame([(r.edited,) for r in rows] + [(t,) for _, t in docs], "text string")
    sets = texts.select(fp.digest_sets(F.col("text")).alias("s")).select(F.explode(F.concat("s.own", "s.coarse")).alias("k")).distinct()
    spot = fp._placed(F.col("k"), F.lit(1), F.lit(fp.CELLS))
    unsigned = lambda x: x & (2**64 - 1)
    placed = {unsigned(r.k): (unsigned(r.p.c), (r.p.p0, r.p.p1, r.p.p2)) for r in sets.select("k", spot.alias("p")).collect()}
    sizes, peeled_pairs = [], 0
    for r, after in zip(rows, rows[1:] + rows[:1], strict=True):
        for near, mine, theirs in ((r.near_edited, r.fingerprint, r.edited_fingerprint), (r.near_next, r.fingerprint, after.fingerprint)):
            a, b = parsed(mine), parsed(theirs)
            if abs(a[0] - b[0]) > 1:
                assert near == 0
                continue
            (n, one), (m, other) = ((x[1], x[3]) if x[0] >= y[0] else (x[2], x[4]) for x, y in ((a, b), (b, a)))
            apart = peeled(one, other, placed)
            if apart is not None:  # else both were asked for larger tables
                peeled_pairs += 1
                assert abs(near - ((n + m - apart) / (n + m + apart) if n + m else 1)) < 1e-12
        sizes.append(len(r.fingerprint))
    assert peeled_pairs > 160 and max(sizes) < 1_600


def test_equal_rows_and_one_hot_id(spark):
    """Rows of one doc_id, null or not, lie in many ranges; equal rows follow each other."""
    rng = random.Random(13)
    words = lambda n: " ".join(f"w{rng.randint(0, 50)}" for _ in range(n))
    docs = [(None, words(9)) for _ in range(120)] + [(7, words(9)) for _ in range(120)] + [(i, words(9)) for i in range(40)]
    docs += [(7, "same text")] * 60 + [(None, None)] * 60 + [(3, "")] * 5
    df = spark.createDataFrame(docs, "doc_id long, text string")
    hashed = {r.text: r.h for r in df.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, hashed[d[1]]), reverse=True)
    wanted = []
    for (k, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        wanted.append((k, text[: len(text) - len(text) // 2] + after[: len(text) // 2]))
    got = [(r.doc_id, r.edited) for r in fp.edits(df).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    spread = fp.with_next(df, parts=8).where("copy = 0").groupBy("range", "piece").agg(F.count(F.lit(1)).alias("n")).collect()
    assert max(r.n for r in spread) < 120
