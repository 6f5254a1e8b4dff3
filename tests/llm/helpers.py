"""Small tables with the awkward cases: nulls, blanks, long texts, ties, repeats, clashing names."""

from __future__ import annotations

LONG = "alpha beta gamma delta " * 5_000
# Names that the operators use inside.
CLASH = ["h", "key", "keys", "n", "set_id", "label", "size", "block", "copy", "range", "start", "word", "rid", "digest"]


def awkward(spark, schema: str = "doc_id long, text string, lang string, source string, n_chars long"):
    rows = [
        (1, "One plain text with some words in it. And a second line\nhere", "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "", 0),
        (4, " \t\n ", "en", "a", 4),
        (5, LONG, "en", "b", len(LONG)),
        (6, LONG, "en", "b", len(LONG)),
        (6, LONG, "en", "b", len(LONG)),
        (7, "x", None, "a", 1),
        (None, "a text without an id", "en", None, 5),
        (8, "ünïcödé 中文 😀 ٣ café", "fr", "c", 9),
    ]
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", *[f"doc_id as {name}" for name in CLASH])


def empty(spark, schema: str = "doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame([], schema)
