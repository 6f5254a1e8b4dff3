from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from vintagelens.llm import jaccard

WIDTH, PERCENT = 5, 80


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + WIDTH]) for i in range(max(1, len(words) - WIDTH + 1))) if words else frozenset()


def brute(docs):
    sets, places, root = {k: shingles(t) for k, t in docs}, defaultdict(list), {k: k for k, _ in docs}
    for k, s in sets.items():
        for shingle in s:
            places[shingle].append(k)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, s in sets.items():
        for other, n in Counter(o for shingle in s for o in places[shingle] if o < k).items():
            if 100 * n >= PERCENT * (len(s) + len(sets[other]) - n):
                a, b = find(k), find(other)
                root[max(a, b)] = min(a, b)
    return {k: find(k) for k in sets}


def varied(seed):
    """Texts of many sizes with words replaced, and with text added or cut off."""
    rng = random.Random(seed)
    base = [[f"w{rng.randint(0, 50)}" for _ in range(rng.choice([5, 8, 9, 10, 12, 20, 30, 60, 200, 500]))] for _ in range(60)]
    docs = []
    for i in range(900):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 9)}"
        cut = rng.choice([0, 0, 0.1, 0.15, 0.2])
        words = words[: max(1, round(len(words) * (1 - cut)))]
        docs.append((i, " ".join(words)))
    return docs


def test_stage_as_brute_force(spark):
    docs = varied(5)
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'en' lang", "'a' source", "1L n_chars")
    kept = corpus_pipeline.one_of_each_group(spark, rows, "")
    assert {r.doc_id for r in kept.collect()} == {k for k, c in brute(docs).items() if c == k}


def test_linked_sets_share_a_key():
    rng = random.Random(8)
    draw = lambda n: {rng.getrandbits(63) for _ in range(n)}
    for percent in (80, 90):
        for _ in range(1500):
            one = draw(rng.choice([4, 5, 6, 9, 12, 20, 40, 99, 300]))
            other = set(one)
            for token in list(one):
                changed = (other - {token}) | (draw(1) if rng.random() < 0.5 else set())
                if 100 * len(one & changed) < percent * len(one | changed):
                    break
                other = changed
            a, b = (np.unique(np.array(sorted(s), np.uint64)) for s in (one, other))
            assert one == other or set(jaccard.keys_of(a, percent)) & set(jaccard.keys_of(b, percent))


def test_no_key_for_empty_groups():
    """Sets without a common token have no common key."""
    rng = random.Random(9)
    seen = Counter()
    for _ in range(2000):
        tokens = np.unique(np.array([rng.getrandbits(63) for _ in range(rng.choice([4, 5, 8, 30, 100]))], np.uint64))
        seen.update(set(jaccard.keys_of(tokens, PERCENT).tolist()))
    assert max(seen.values()) == 1


def test_a_passage_that_many_hold_makes_no_cluster(spark, monkeypatch):
    """Texts that have a passage in common are not dealt to tasks as one cluster of near copies."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(24)]
    docs = []
    for i in range(400):
        own = [f"w{rng.getrandbits(40)}" for _ in range(40)]
        docs.append((2 * i, " ".join(own[:20] + passage + own[20:])))
        if i % 10 == 0:
            docs.append((2 * i + 1, " ".join(own[:20] + passage + own[20:-1] + ["z"])))
    blocks, write = [], jaccard.stored

    def stored(df, name, *more):
        out = write(df, name, *more)
        if name == "jaccard-clusters":
            blocks.append(max((r.blocks for r in out.collect()), default=0))
        return out

    monkeypatch.setattr(jaccard, "stored", stored)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 8)
    found = jaccard.groups(spark.createDataFrame(docs, "doc_id long, text string"), width=WIDTH, percent=PERCENT)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute(docs)
    assert blocks[0] > 16 and blocks[-1] <= 2


def test_large_clusters_as_brute_force(spark, monkeypatch):
    """All clusters are clustered again by their rarest groups, and cut into blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 1)
    docs = varied(6)
    found = jaccard.groups(spark.createDataFrame(docs, "doc_id long, text string"), width=WIDTH, percent=PERCENT)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute(docs)
