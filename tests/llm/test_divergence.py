from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import awkward, empty
from vintagelens.llm import divergence
from vintagelens.llm.common import LOWER, prepare, utf8

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWERED = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return TERM.findall((text or "").translate(LOWERED))


def brute(rows, least=30, most=50):
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        found = terms(text)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: {t: counts[lang, s][t] for t in kept} for s in names}
        own[None] = {t: sum(own[s][t] for s in names) for t in kept}
        share = {s: {t: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for t, n in c.items()} for s, c in own.items()}
        for s in names:
            pairs = [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in names if o != s]
            ahead = [(share[s][t] - share[None][t], t) for t in kept if own[s][t] and share[s][t] > share[None][t]]
            for part, found, cut in (("pair", pairs, None), ("term", ahead, most)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:cut])]
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in divergence.audit(df, **options).collect())


def test_equal_runs_are_the_terms_in_order():
    draw = random.Random(3)
    letters = ["a", "b", "A", "é", "中", "aaaaaaaa", "bbbbbbbbb", " ", "1", "_", "\x7f", "."]
    for n in range(200):
        texts = ["".join(draw.choices(letters, k=draw.randint(0, 30))) for _ in range(draw.randint(1, 12))]
        data, offsets = utf8(pa.array(texts))
        data = LOWER[data]
        starts, lengths, run, row = divergence.equal_runs(data, offsets, size=draw.choice([1, 4, 1000]))
        names = [bytes(data[s : s + n]) for s, n in zip(starts, lengths, strict=True)]
        got = defaultdict(list)
        for r, at in zip(run.tolist(), row.tolist(), strict=True):
            got[names[r].decode()].append(at)
        expected = defaultdict(list)
        for i, text in enumerate(texts):
            for term in terms(text):
                expected[term].append(i)
        assert got == expected and names == sorted(names)


def test_long_terms_and_ends_of_the_buffer():
    data, offsets = utf8(pa.array(["x" * 1000, "x" * 1000, "x" * 999 + "y", "", "x" * 1000]))
    starts, lengths, run, row = divergence.equal_runs(data, offsets)
    assert lengths.tolist() == [1000, 1000] and np.bincount(run).tolist() == [3, 1] and row.tolist() == [0, 1, 4, 2]


@pytest.mark.parametrize("shard_bytes, slice_terms", [(1, 1), (500, 3), (8 << 20, 2048)])
def test_equals_brute_force(spark, shard_bytes, slice_terms):
    prepare(spark)
    draw = random.Random(5)
    words = ["w" + c * k for c in "abcdefg" for k in (1, 3, 12)] + ["Über", "中文", "Zz"]
    rows = []
    for _ in range(300):
        lang, source = draw.choice(["en", "de", "", None]), draw.choice(["s1", "s2", "S3", None, "é"])
        rows.append((" ".join(draw.choices(words, k=draw.randint(0, 8))), lang, source))
    rows += [(None, "xx", "only"), ("1 2 3", "yy", "a"), (None, "yy", "b")] + [("same words here", "zz", "a")] * 40
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert found(df, least_documents=12, shard_bytes=shard_bytes, slice_terms=slice_terms) == brute(rows, 12)
    assert found(df, most_terms=2) == brute(rows, 30, 2)


def test_more_sources_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 3)
    prepare(spark)
    draw = random.Random(8)
    rows = [(" ".join(draw.choices("abcdefghij", k=6)), "en", f"s{draw.randint(0, 10):02}") for _ in range(200)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert found(df, least_documents=5, slice_terms=4) == brute(rows, 5)


def test_awkward_and_empty(spark):
    df = awkward(prepare(spark))
    rows = [(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()]
    assert found(df, least_documents=1) == brute(rows, 1)
    assert found(empty(spark)) == []


def test_query_equals_its_sql(spark, sf_dir):
    from checks.compare import connect, spark_rows, sql_rows
    from vintagelens.llm.queries import ORACLES, QUERIES

    names, rows = spark_rows(QUERIES["op13_divergence"](spark, sf_dir))
    assert (names, rows) == sql_rows(connect(sf_dir), ORACLES["op13_divergence"]) and rows
