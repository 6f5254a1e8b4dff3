from __future__ import annotations

import random

import pytest

from tests.llm.helpers import awkward, empty
from vintagelens.llm import lines


def dropped(spark, docs):
    rows = lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return {r.doc_id: (r.dropped, r.text) for r in rows}


def test_variable_fields_are_one_template(spark):
    found = dropped(spark, [
        (1, "User 12 logged in from host alpha today\nsomething quite unique in this very line here"),
        (2, "User 99 logged in from host beta today\nanother text altogether that nobody else ever wrote"),
        (3, "User 5 logged in from host gamma today\nshort line"),
        (4, "short line\nUser 7 logged out of host gamma today now"),
    ])
    assert [found[k][0] for k in (1, 2, 3, 4)] == [[], [0], [0], []]
    assert found[2][1] == "another text altogether that nobody else ever wrote"


def test_as_brute_force_without_fields(spark):
    """Lines without anything in common but whole copies: a copy goes, but in its first document."""
    own = lambda i: f"n{i * 7}x a{i} b{i} c{i} d{i} e{i}".translate({48 + k: 97 + k for k in range(10)})
    docs = [(i, "\n".join(own(j) for j in (i, i // 2 + 500, i % 5 + 900))) for i in range(60)]
    first = {}
    for k, text in docs:
        for line in text.split("\n"):
            first.setdefault(line, k)
    found = dropped(spark, docs)
    for k, text in docs:
        assert found[k][1] == "\n".join(x for x in text.split("\n") if first[x] == k)


def log_lines(seed):
    """Lines of templates that differ in half their words, with one or two words or numbers as fields."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    heads = [[word(4) for _ in range(3)] for _ in range(2)]
    forms = []
    for _ in range(25):
        width = rng.choice([11, 12, 13])
        tokens = [*rng.choice(heads), *[word(6) for _ in range(width - 3)]]
        forms.append((tokens, rng.sample(range(3, width), rng.choice([1, 2]))))
    docs = []
    for i in range(120):
        text = []
        for _ in range(rng.randint(1, 6)):
            tokens, fields = rng.choice(forms)
            filled = {f: rng.choice([str(rng.randint(0, 9999)), word(5)]) for f in fields}
            text.append(" ".join(filled.get(j, t) for j, t in enumerate(tokens)))
        docs.append((i, "\n".join([*text, " ".join(word(7) for _ in range(9))])))
    return docs


def brute_templates(docs, similarity=0.8):
    """Texts left, from all pairs of lines: a template is what links of similar lines connect."""
    masked = lambda line: [lines.FIELD if any(c.isdigit() for c in t) else t for t in line.split()]
    places = [(k, n, masked(line)) for k, text in docs for n, line in enumerate(text.split("\n"))]
    root = list(range(len(places)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, _, one) in enumerate(places):
        for j in range(i):
            other = places[j][2]
            if len(one) == len(other) and one[:3] == other[:3]:
                if sum(a == b for a, b in zip(one, other, strict=True)) >= similarity * len(one) - 1e-9:
                    root[max(find(i), find(j))] = min(find(i), find(j))
    first = {}
    for i, (k, _, _) in enumerate(places):
        first[find(i)] = min(k, first.get(find(i), k))
    gone = {(k, n) for i, (k, n, _) in enumerate(places) if first[find(i)] != k}
    return {k: "\n".join(x for n, x in enumerate(text.split("\n")) if (k, n) not in gone) for k, text in docs}


@pytest.mark.parametrize("part_lines", [lines.PART_LINES, 12])
def test_as_brute_force_with_fields(spark, part_lines):
    """Also where a leaf has many more lines than a part, and its templates meet in rounds."""
    docs = log_lines(part_lines)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.text for r in lines.dedup(df, part_lines=part_lines).collect()}
    wanted = brute_templates(docs)
    assert found == wanted and sum(found[k] != t for k, t in docs) > 60


def test_templates():
    found, templates = lines.form_templates([x.split() for x in ("a b c d e", "a b c d f", "a b x y e")], 0.8)
    assert found == [0, 0, 1] and templates[0] == ["a", "b", "c", "d", lines.FIELD]


def test_awkward_rows(spark):
    rows = lines.dedup(awkward(spark)).collect()
    assert len(rows) == 10 and {r.doc_id: r.dropped for r in rows}[6] == [0]
    assert lines.dedup(empty(spark)).count() == 0
