"""Corpus pipeline: each stage takes (spark, docs, sf_dir) and returns what it keeps.

The stages read whole tables and keep the columns of ``documents``; the last returns token ids
and a digest of what they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens.llm import bpe, jaccard, lines, mixing, toxicity
from vintagelens.llm.common import prepare, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = "byte_bpe_50k.tiktoken"
# Half of the operator's default: workers of a long pipeline share memory with what went before.
CHUNK_BYTES = 16 << 20
# Near copies: shingles of five words, of which 80 percent are shared.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not predict as toxic.

    Each row is judged by its own text: rows that share a doc_id, or have none, as well.
    """
    prepare(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs.select(*COLUMNS), model)


def by_row(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with what an operator found for a doc_id and the hash ``h`` of its text."""
    own = docs.withColumn("_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = found.dropDuplicates(["doc_id", "h"]).withColumnRenamed("doc_id", "_id")
    return own.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("h")), how)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of templates that an earlier document has.

    A document of which no text is left goes.
    """
    prepare(spark)
    left = lines.dedup(docs).where(F.size("dropped") > 0)
    joined = by_row(docs, left.select("doc_id", "h", F.col("text").alias("_left")), "left")
    emptied = F.col("_left").isNotNull() & ~F.col("_left").rlike(r"[^\x20\x09-\x0D]")
    kept = joined.where(~emptied).withColumn("text", F.coalesce("_left", "text"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies.

    Rows that repeat a doc_id stay or go together; rows without one stay.
    """
    prepare(spark)
    found = jaccard.groups(docs, width=NEAR_SHINGLE, percent=NEAR_PERCENT)
    later = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as the mix takes them; a document without copies goes.

    Rows that are alike in doc_id, source and text are one document here: one of them stands
    for all, and takes the copies of all.
    """
    prepare(spark)
    key = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("source").isNull(), F.col("source"), F.col("h")]
    key = F.xxhash64(*key).alias("_key")
    copies = mixing.mix(docs).select(key, "copies").groupBy("_key").agg(F.sum("copies").alias("_copies")).where("_copies > 0")
    rows = docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).select(*COLUMNS, key).dropDuplicates(["_key"])
    taken = rows.join(copies, "_key")
    return taken.selectExpr(*COLUMNS, "explode(sequence(1L, _copies)) as _copy").drop("_copy")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and what they decode to: doc_id, n_tokens, ids, decoded_sha256."""
    prepare(spark)
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, chunk_bytes=CHUNK_BYTES)
    decoded = bpe.decode(encoded, ranks)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_recurring_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
