from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from vintagelens.llm import ann


def brute(ids, vectors, asked, k):
    out = {}
    for q in asked:
        scores = (vectors * vectors[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = ids[order].tolist()
    return out


def frame(spark, ids, vectors):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(3_000, 48)).astype(np.float32).astype(float)
    vectors[500:900] = vectors[500]  # one very common vector
    ids = np.arange(3_000)
    df = frame(spark, ids, vectors)
    asked = df.where("vec_id % 100 = 0")
    rows = ann.search(df, asked, 20, block_rows=700, group_rows=9).collect()
    wanted, hits = brute(ids, vectors, range(0, 3_000, 100), 20), 0
    for q, near in wanted.items():
        own = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        keys = [(-r.score, r.vec_id) for r in own]
        assert keys == sorted(keys) and all(np.isclose(r.score, vectors[r.vec_id] @ vectors[q]) for r in own)
        hits += len({r.vec_id for r in own} & set(near))
    assert hits / (20 * len(wanted)) >= 0.9
    common = [r.vec_id for r in sorted((r for r in rows if r.query_id == 600), key=lambda r: r["rank"])]
    assert common == list(range(500, 520))


def test_bounds_hold_mostly():
    rng = np.random.default_rng(1)
    vectors, queries = rng.normal(size=(2_000, 64)), rng.normal(size=(20, 64))
    turn = ann.rotation(64)
    bits, lengths, alignments = ann.encode(vectors, turn)
    found, error = ann.estimate(bits, lengths, alignments, queries, turn, ann.SURENESS)
    assert bits.shape == (2_000, 8) and (np.abs(found - queries @ vectors.T) <= error).mean() > 0.98


def test_awkward_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
        (6, [1.0, None]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, []), (9, [0.5, 0.5]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1)).withColumn("key", F.lit(2))
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(df, df.where("vec_id = 0 or vec_id = 4"), 20).collect()]
    assert sorted(found) == [(0, 1, 1, 0.5), (0, 2, 9, 0.5)]
    assert ann.search(df.where("false"), df, 20).count() == 0
    assert ann.search(df.where("vec_id = 0"), df.where("vec_id = 0"), 20).count() == 0


def test_any_magnitude(spark):
    """Finite vectors of every size: products may overflow or vanish, but no vector is lost."""
    rng = np.random.default_rng(7)
    for powers in (np.full(300, 160), np.full(300, -160), rng.integers(-150, 150, 300)):
        vectors = rng.normal(size=(300, 16)) * 10.0 ** powers[:, None]
        rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = {}
        for r in ann.search(df, df.where("vec_id % 20 = 0"), 20, block_rows=64, group_rows=4).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        hits = 0
        for q in range(0, 300, 20):
            with np.errstate(over="ignore", invalid="ignore"):
                scores = (vectors * vectors[q]).sum(axis=1)
            scores[np.isnan(scores)] = -np.inf
            order = [int(i) for i in np.lexsort((np.arange(300), -scores)) if i != q][:20]
            own = sorted(got[q])
            assert [k for k, _, _ in own] == list(range(1, 21)) and all(s == scores[i] for _, i, s in own)
            hits += len({i for _, i, _ in own} & set(order))
        assert hits >= 0.9 * 20 * 15


def test_a_block_is_sent_once_for_many_groups(spark):
    """However queries are gathered, the same rows come back, also where a block got no vector."""
    rng = np.random.default_rng(3)
    df = frame(spark, np.arange(120), rng.normal(size=(120, 8)))
    asked = df.where("vec_id % 3 = 0")
    found = []
    for settings in ({"block_rows": 2, "group_rows": 1}, {"block_rows": 40, "group_rows": 7, "meeting_groups": 2}, {}):
        rows = ann.search(df, asked, 5, sureness=20.0, **settings).collect()
        found.append(sorted((r.query_id, r["rank"], r.vec_id) for r in rows))
    assert len(found[0]) == 40 * 5 and found[0] == found[1] == found[2]
