from __future__ import annotations

import hashlib
import re

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.helpers import awkward, empty
from tests.llm.test_jaccard import brute
from vintagelens.llm import mixing, toxicity
from vintagelens.llm.common import stored, table

DATA = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    docs, kept = table(spark, DATA, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, DATA), "test-stage")
        kept.append((name, docs))
    frames = [d for _, d in kept]
    assert all(d.columns == corpus_pipeline.COLUMNS for d in frames[:-1])
    assert frames[0].count() < table(spark, DATA, "documents").count()
    before = [(r.doc_id, r.text) for r in frames[1].collect()]
    assert {r.doc_id for r in frames[2].collect()} == {k for k, (_, c) in brute(before).items() if c == k}
    assert {r.doc_id for r in frames[3].collect()} <= {r.doc_id for r in frames[2].collect()}
    assert frames[4].count() == frames[3].count()


def test_awkward_and_empty_tables(spark):
    columns = corpus_pipeline.COLUMNS
    for docs in (awkward(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, DATA), "test-stage")
        assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and columns


def test_registered():
    names = contract.queries()
    assert "pipeline" in names and all(any(re.match(rf"op{n}_", x) for x in names) for n in range(1, 11))


def test_rows_are_judged_by_their_own_text(spark):
    """Repeated and missing doc_ids: toxic rows go, clean rows that share an id stay, copies keep the mix's total."""
    docs = table(spark, DATA, "documents")
    model = toxicity.learn(docs, table(spark, DATA, "labels"))
    marked = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    rows = docs.limit(120).collect()
    odd = []
    for i, r in enumerate(rows):
        odd += [(None if i % 3 == 0 else i // 4, r.text, r.lang, r.source, r.n_chars)] * (1 + i % 2)
    frame = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    wanted = [(r.text, marked[r.doc_id]) for i, r in enumerate(rows) for _ in range(1 + i % 2)]
    kept = toxicity.drop_toxic(frame, model).collect()
    assert sorted(str(r.text) for r in kept) == sorted(str(t) for t, p in wanted if not p)
    mixed, taken = corpus_pipeline.mix_sources(spark, frame, DATA), mixing.mix(frame)
    n_words = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert sum(n_words(r.text) for r in mixed.collect()) == taken.agg({"taken": "sum"}).first()[0]


def test_tokens_decode_to_the_text(spark):
    docs = awkward(spark).select(*corpus_pipeline.COLUMNS)
    rows = corpus_pipeline.tokens(spark, docs, DATA).collect()
    wanted = [hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect()]
    assert sorted(r.decoded_sha256 for r in rows) == sorted(wanted)
