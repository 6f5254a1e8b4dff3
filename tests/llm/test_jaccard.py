from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from tests.llm.helpers import awkward, empty
from vintagelens.llm import jaccard


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


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
            if 100 * n >= 90 * (len(s) + len(sets[other]) - n):
                a, b = find(k), find(other)
                root[max(a, b)] = min(a, b)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def test_groups_as_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    base = [[f"w{rng.randint(0, 50)}" for _ in range(rng.choice([1, 2, 3, 8, 9, 10, 12, 20, 30, 60, 200]))] for _ in range(40)]
    docs = []
    for i in range(900):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 9)}"
        docs.append((i, " ".join(words)))
    docs += [(900, None), (901, ""), (902, "  \n"), (903, "A"), (904, "a")]
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)  # so that clusters take several blocks
    found = jaccard.groups(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute(docs)


def test_tree_keeps_every_pair_that_links():
    rng = random.Random(4)
    pool = [np.unique(np.array([rng.getrandbits(63) for _ in range(60)], np.uint64)) for _ in range(5)]
    sets = []
    for _ in range(200):
        own = pool[rng.randrange(5)].copy()
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = rng.getrandbits(63)
        sets.append(np.unique(own))
    tree = jaccard.CountTree(sets)
    for place in range(len(sets)):
        near = set(tree.near(place, 90).tolist())
        for other in range(place + 1, len(sets)):
            a, b = sets[tree.order[place]], sets[tree.order[other]]
            shared = len(np.intersect1d(a, b))
            assert other in near or 100 * shared < 90 * (len(a) + len(b) - shared)


def test_awkward_rows(spark):
    rows = {r.doc_id: r for r in jaccard.groups(awkward(spark)).collect()}
    assert None not in rows and rows[6].component_id == 5 and rows[3].n_shingles == 0 and rows[2].component_id == 2
    assert jaccard.groups(empty(spark)).count() == 0
