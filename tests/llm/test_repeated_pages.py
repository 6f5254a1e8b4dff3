from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from vintagelens.llm import warc
from vintagelens.llm.queries import QUERIES


def test_repeated_rows_come_back_as_often_as_they_are(spark, tmp_path):
    schema = "page_id long, url string, html string"
    rows = [(1, "http://e.com/", "x" * 1200)] * 3 + [(2, "http://e.com/", "x" * 1200)] * 2 + [(3, None, "")] * 2 + [(4, "http://o.org/", "y")]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    found = QUERIES["op6_warc"](spark, str(tmp_path)).collect()
    assert Counter(r.page_id for r in found) == {1: 3, 2: 2, 3: 2, 4: 1}
    assert {(r.record_type, r.refers_to) for r in found if r.page_id == 1} == {("revisit", 2)}


def test_blocks_and_regions_are_dealt_to_many_tasks(spark, tmp_path):
    """Equal lines over several blocks, lines asked for twice, and a read-back that is spread."""
    pages = spark.range(400).selectExpr("id % 80 as page_id", "'http://e.com/' || (id % 80) as url", "'p' || (id % 80) as html")
    archives, folder = str(tmp_path / "warc"), str(tmp_path / "index")
    captures = warc.write(pages.repartition(6), archives)
    index = warc.index(captures, folder, block_lines=2)
    asked = captures.select("key", "page_id").distinct()
    assert warc.lookup(index, archives, asked).groupBy("page_id").count().where("count <> 5").count() == 0
    found = warc.lookup(index, archives, asked.unionAll(asked.where("page_id = 3")))
    assert {r.page_id: r["count"] for r in found.groupBy("page_id").count().collect()} == {i: 10 if i == 3 else 5 for i in range(80)}
    tasks = found.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1
    before = asked.limit(1).selectExpr("'' as key", "page_id").unionAll(asked.limit(1).selectExpr("'zz' as key", "page_id"))
    assert warc.lookup(index, archives, before).count() == 0
