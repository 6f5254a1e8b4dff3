"""Language and toxicity models: held-out accuracy, awkward rows, determinism."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty
from vintagelens.llm import langid, toxicity
from vintagelens.llm.common import table, utf8
from vintagelens.llm.queries import QUERIES, held_out

DATA = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    rows = QUERIES["op3_language"](spark, DATA).join(table(spark, DATA, "documents").select("doc_id", "lang"), "doc_id")
    hit = rows.where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert hit > 0.97


def test_kernel_as_sets():
    texts = ["abcabc", "bcd", "zzzz", "a"]
    slots, ends = langid.slots_of_step(*utf8(pa.array(texts)))
    rows = np.split(slots, ends[1:-1])
    grams = [{t[i : i + n] for n in langid.ORDERS for i in range(len(t) - n + 1)} for t in texts]
    wanted = [[len(a & b) / np.sqrt(max(1, len(a)) * max(1, len(b))) for b in grams] for a in grams]
    assert np.allclose(langid.kernel(rows, rows), wanted)


def test_language_awkward_rows(spark):
    docs = awkward(spark)
    model = langid.learn(docs)
    rows = langid.predict(docs, model).collect()
    assert len(rows) == 10
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id in (1, 8)} <= {"en", "fr"}
    assert all(0 <= r.score <= 1 for r in rows)
    assert langid.learn(empty(spark)) is None
    assert [r.lang_pred for r in langid.predict(docs, None).collect()] == ["und"] * 10


def test_toxicity_held_out(spark):
    labels = table(spark, DATA, "labels").where(held_out())
    scored = QUERIES["op5_toxicity"](spark, DATA).join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    good, bad = scored.score[scored.toxic == 0].to_numpy(), scored.score[scored.toxic == 1].to_numpy()
    assert (bad[:, None] > good[None, :]).mean() > 0.8
    assert (scored.toxic[scored.predicted == 1] == 1).mean() > 0.8


def test_toxicity_learns_beginnings_of_words():
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    texts, marks = [], []
    for i in range(600):
        words = [word() for _ in range(40)]
        if i % 3 == 0:
            words[int(rng.integers(40))] = "qqqq" + word()
        texts.append(" ".join(words))
        marks.append(int(i % 3 == 0))
    order = rng.permutation(600)
    texts, marks = [texts[i] for i in order], [marks[i] for i in order]
    model = toxicity.fit(texts[:450], marks[:450], ["en"] * 450)
    slots, edges = toxicity.word_slots(*utf8(pa.array(texts[450:])))
    hits = (toxicity.logits(model, slots, edges) > model.cuts[0]) == (np.array(marks[450:]) == 1)
    assert hits.mean() > 0.97


def test_toxicity_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (5, 1, 1), (6, 0, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert toxicity.learn(empty(spark), labels) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_one_text_does_not_flood_the_language_sample(spark):
    rng = np.random.default_rng(9)
    word = lambda letters: "".join(rng.choice(list(letters), 6))
    rows = [("the one text that is everywhere", "en")] * 20_000
    for lang, letters, n in (("en", "abcdefgh", 600), ("fr", "ijklmnop", 300), ("de", "qrstuvwx", 300), ("xx", "yzéü", 7)):
        rows += [(" ".join(word(letters) for _ in range(6)), lang) for _ in range(n)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    texts, languages = langid.sample(docs, per_language=100)
    counts = {lang: languages.count(lang) for lang in set(languages)}
    assert counts == {"en": 100, "fr": 100, "de": 100, "xx": 7} and len(set(texts)) == len(texts)


def test_more_languages_than_are_learned(spark):
    rows = [(f"text {i} in language {i % 9}", f"l{i % 9}") for i in range(90)] + [("more of zero", "l0")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert set(langid.sample(docs, 5, most_languages=4)[1]) == {"l0", "l1", "l2", "l3"}


def test_repeated_rows_do_not_flood_the_toxicity_sample(spark, monkeypatch):
    rows = [(1, f"repeated {i % 2}", "en") for i in range(3_000)] + [(i, f"other text {i}", "en") for i in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 0), (1, 1), *[(i, i % 2) for i in range(2, 12)]], "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda texts, marks, langs: seen.update(texts=texts, marks=marks))
    toxicity.learn(docs, labels, 20, 20)
    assert len(seen["texts"]) == 11 and sum(t.startswith("repeated") for t in seen["texts"]) == 1
    assert dict(zip(seen["texts"], seen["marks"], strict=True))[next(t for t in seen["texts"] if t[0] == "r")] == 1
    toxicity.learn(docs, labels, 3, 2)
    assert seen["marks"].count(1) == 3 and seen["marks"].count(0) == 2


def test_toxicity_learns_from_every_labelled_text(spark, monkeypatch):
    rows = [(i, f"word{i} and word{i + 1} of {'en' if i % 2 else 'fr'}", "en" if i % 2 else "fr") for i in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(6_000)], "doc_id long, toxic int")
    seen, begin = {}, toxicity.begin
    monkeypatch.setattr(toxicity, "begin", lambda counts, seed: seen.update(counts=counts) or begin(counts, seed))
    toxicity.learn(docs, labels)
    n_toxic, n_clean = seen["counts"].texts
    assert n_toxic + n_clean == 4_500  # a quarter is held back for the cuts
    assert {name: words.sum() for name, words in seen["counts"].words.items()} == {"en": 15_000, "fr": 15_000}


def test_toxicity_shards_agree_with_one_task(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    rows = []
    for i in range(1_200):
        words = [word() for _ in range(20)]
        if i % 4 == 0:
            words[int(rng.integers(20))] = "qqqq" + word()
        rows.append((i, int(i % 4 == 0), " ".join(words), ("en", "fr")[i % 2], int(rng.integers(1 << 40))))
    frame = spark.createDataFrame(rows, "doc_id long, toxic int, text string, lang string, place long")
    ordered = sorted(rows, key=lambda r: (r[4], r[0]))
    local = toxicity.fit([r[2] for r in ordered], [r[1] for r in ordered], [r[3] for r in ordered])
    one = toxicity._learn_in_shards(frame)
    for name in ("table", "filters", "bias", "out", "language"):
        assert np.allclose(getattr(local, name), getattr(one, name), atol=1e-5)
    assert np.allclose(local.cuts, one.cuts, atol=1e-4)
    many = toxicity._learn_in_shards(frame, shard_bytes=20_000)
    again = toxicity._learn_in_shards(frame, shard_bytes=20_000)
    assert all(np.array_equal(getattr(many, n), getattr(again, n)) for n in ("table", "filters", "bias", "out", "cuts"))
    slots, edges = toxicity.word_slots(*utf8(pa.array([r[2] for r in rows])))
    hits = (toxicity.logits(many, slots, edges) > many.cuts[0]) == (np.array([r[1] for r in rows]) == 1)
    assert hits.mean() > 0.97


def test_cuts_as_on_the_driver(spark):
    rng = np.random.default_rng(6)
    z, y, k = rng.normal(0, 2, 900).astype(np.float32), rng.integers(0, 2, 900), rng.integers(0, 3, 900)
    z += y
    scores = spark.createDataFrame([*zip(k.tolist(), z.astype(float).tolist(), y.tolist())], "k int, z double, y int")
    model = toxicity.Model(*[None] * 6, np.zeros(4))
    toxicity.best_cuts(model, scores)
    wanted = [toxicity._best_cut(z[k == i], y[k == i].astype(np.float32)) for i in range(3)]
    assert np.allclose(model.cuts, [*wanted, toxicity._best_cut(z, y.astype(np.float32))], atol=1e-6)
