from __future__ import annotations

import gzip
import hashlib

from pyspark.sql import functions as F

from vintagelens.llm import warc

PAGES = [
    (1, "http://www.Example.com/a?b=1", "x" * 1000),
    (2, "https://sub.example.com:8080/", "x" * 1000),
    (9, "https://other.org/p q", "x" * 1000),
    (3, None, "x" * 999),
    (4, "http://example.com/", "x" * 999),
    (5, "http://example.com/", None),
    (6, "not a url\n", "é" * 600),
    (7, "http://[bad", "é" * 600),
    (8, "http://example.com/", ""),
]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as first")
    archives, folder = str(tmp_path / "warc"), str(tmp_path / "index")
    captures = warc.write(pages, archives)
    index = warc.index(captures, folder, block_lines=2)
    rows = {r.page_id: r for r in warc.lookup(index, archives, captures).collect()}
    assert len(rows) == len(PAGES)
    first = {"x" * 1000: 9, "é" * 600: 7}
    for page, _, html in PAGES:
        data, row = (html or "").encode(), rows[page]
        assert row.payload_bytes == len(data) and row.payload_digest == hashlib.sha1(data).hexdigest()
        revisit = html in first and first[html] != page
        assert row.record_type == ("revisit" if revisit else "response")
        assert row.refers_to == (first[html] if revisit else None)
        assert row.payload is None if revisit else bytes(row.payload) == data
    some = captures.where("page_id in (4, 5)").select("key", "page_id").union(spark.createDataFrame([("com,none)/ 1", 1)], "key string, page_id long"))
    assert sorted(r.page_id for r in warc.lookup(index, archives, some).collect()) == [4, 5]
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").iterdir())
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES)


def test_keys_and_many_captures_of_one_url(spark, tmp_path):
    assert warc.url_key("http://www.Example.com:80/A?b") == "com,example)/a?b"
    assert warc.url_key(None) == warc.url_key("http://[bad") == "-"
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.lit("http://e.com/").alias("url"), F.col("id").cast("string").alias("html"))
    archives, folder = str(tmp_path / "warc"), str(tmp_path / "index")
    captures = warc.write(pages, archives)
    index = warc.index(captures, folder, block_lines=7)
    assert index.directory.count() >= 500 // 7
    assert warc.lookup(index, archives, captures).select("page_id").distinct().count() == 500


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    captures = warc.write(pages, str(tmp_path / "a"))
    assert warc.lookup(warc.index(captures, str(tmp_path / "b")), str(tmp_path / "a"), captures).count() == 0
