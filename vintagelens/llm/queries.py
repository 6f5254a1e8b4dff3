"""One query per operator over its whole table: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens.llm import ann, bpe, divergence, fingerprint, jaccard, langid, lines, mixing, repeats, tokencount, toxicity, warc, whitening
from vintagelens.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def held_out(key: str = "doc_id"):
    """A quarter of the rows, on which models are measured and from which they never learn."""
    return F.crc32(F.col(key).cast("string")) % 4 == 2


def query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


@query
def op1_bpe(spark, d):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    decoded = bpe.decode(bpe.encode(table(spark, d, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query
def op2_lines(spark, d):
    left = lines.dedup(table(spark, d, "documents"))
    return left.select(
        "doc_id",
        "n_lines",
        F.size("dropped").cast("long").alias("n_dropped"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"),
    )


@query
def op3_language(spark, d):
    docs = table(spark, d, "documents")
    model = langid.learn(docs.where(~held_out()))
    return langid.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op4_repeats(spark, d):
    kept = repeats.remove(table(spark, d, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"),
        F.size("passages").cast("long").alias("n_passages"),
    )


@query
def op5_toxicity(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    model = toxicity.learn(docs, labels.where(~held_out()))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op6_warc(spark, d):
    pages = table(spark, d, "pages")
    archives, index_folder = warc.new_folder(pages, "warc"), warc.new_folder(pages, "warc-index")
    captures = warc.write(pages, archives)
    # Each capture key once: the lookup gives all records of a key, also those of repeated rows.
    wanted = captures.select("key", "page_id").distinct()
    found = warc.lookup(warc.index(captures, index_folder), archives, wanted, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op6_warc"] = """
with p as (
  select page_id, coalesce(html, '') html, octet_length(encode(coalesce(html, ''))) payload_bytes,
    sha1(coalesce(html, '')) payload_digest from pages),
f as (select payload_digest, max(page_id) first from p where payload_bytes >= 1000 group by payload_digest)
select page_id, payload_bytes, payload_digest,
  case when first is null or first = page_id then 'response' else 'revisit' end record_type,
  case when first <> page_id then first end refers_to
from p left join f using (payload_digest)
"""


@query
def op7_ann(spark, d):
    vectors = table(spark, d, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"))


@query
def op8_jaccard(spark, d):
    return jaccard.groups(table(spark, d, "documents"))


@query
def op9_mixing(spark, d):
    mixed = mixing.mix(table(spark, d, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op10_fingerprints(spark, d):
    found = fingerprint.edits(table(spark, d, "documents"))
    hashed = found.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    marks = ["fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return hashed.select("doc_id", "n_chars", "edited_sha256", *marks)


@query
def op11_token_counts(spark, d):
    return tokencount.count(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@query
def op12_whitening(spark, d):
    return whitening.whiten(table(spark, d, "embeddings"), components=16)


@query
def op13_divergence(spark, d):
    return divergence.audit(table(spark, d, "documents"))


ORACLES["op13_divergence"] = r"""
with d as (
  select row_number() over () doc, coalesce(text, '') t, coalesce(lang, '') lang, coalesce(source, '') source from documents),
o as (
  select doc, lang, source, unnest(regexp_extract_all(
    translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from d),
n as (select lang, source, term, count(*) n, count(distinct doc) docs from o group by all),
k as (select lang, term, sum(n)::hugeint total from n group by all having sum(docs) >= 30),
v as (select lang, count(*) terms, sum(total) lang_size from k group by all),
g as (select distinct lang, source from d),
gs as (
  select lang, source, coalesce(sum(n.n) filter (k.term is not null), 0)::hugeint size
  from g left join n using (lang, source) left join k using (lang, term) group by all),
s as (
  select lang, source, term, coalesce(n.n, 0) n,
    1 + (1000000000 * (coalesce(n.n, 0)::hugeint + 5)) // (size + 5 * terms)::hugeint p,
    1 + (1000000000 * (total + 5)) // (lang_size + 5 * terms)::hugeint q
  from gs join v using (lang) join k using (lang) left join n using (lang, source, term)),
f as (
  select a.lang, a.source, b.source item, sum(abs(a.p - b.p)) far
  from s a join s b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' part, b.source item, coalesce(far, 0)::bigint value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join f on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (select lang, source, 'term' part, term item, (p - q)::bigint value from s where n > 0 and p > q),
r as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::integer rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 50
"""
