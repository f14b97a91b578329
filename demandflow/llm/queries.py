"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.llm import (
    chat_format, conversation_repair, decontamination, lm_scoring, ngram_join, packing, pii, quality_classifier, quality_rules,
    secret_scan, url_filter, warc, whitening)
from demandflow.llm.common import Scratch, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document.  The labels grade it: 0 poor, 1 well
    written but toxic, 2 well written and not toxic; kept if grade 2 is likelier than not."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    model = quality_classifier.train(docs, labels.where("quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", grade.alias("grade")))
    return quality_classifier.scored(docs, model).withColumn("kept", F.col("tail_probability") >= 0.5)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    scratch = Scratch(spark, "op2")
    parts = packing.pieces(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(parts, scratch)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation repaired at the least cost and rendered, one row per turn."""
    return chat_format.repair(table(spark, sf_dir, "conversations"), Scratch(spark, "op3"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under 5-word shingles and Jaccard 0.8."""
    return ngram_join.clusters(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op4"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it leaks."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op5"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives, read back, and checked against the chain of boundaries."""
    scratch = Scratch(spark, "op6")
    path = scratch.path("archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.candidates(spark, path).select(
        "file", "offset", "next", "page_id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("own_bytes"))
    records = scratch.write(warc.reachable(scratch.write(found, "candidates"), scratch), "records")
    # a revisit's payload is that of the response it refers to: ids may repeat, so the digest decides as well
    full = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.max("own_bytes").alias("full_bytes"))
    out = records.join(full, ["refers_to", "digest"], "left")
    return out.select("page_id", F.coalesce("full_bytes", "own_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                      "record_type", "refers_to")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base rules and the learned decision list's verdict."""
    scratch = Scratch(spark, "op7")
    stats = quality_rules.with_statistics(table(spark, sf_dir, "documents").select("doc_id", "text"))
    stats = scratch.write(stats.select("row.doc_id", *quality_rules.STATISTICS, "base_failed"), "statistics")
    rules = quality_rules.learn(stats, table(spark, sf_dir, "labels"), scratch)
    return quality_rules.judged(stats, rules).select("doc_id", *quality_rules.BASE, "base_failed", "kept")


#: Fixed rules of the query (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, else by the cascade of listed hosts.  The stand-in list
    holds the hosts that begin with ``ads`` and those whose length is a multiple of five."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = url_filter.with_parts(pages).select(F.col("host").alias("key"))
    listed = hosts.where("key LIKE 'ads%' OR (key <> '' AND char_length(key) % 5 = 0)")
    return url_filter.judge(pages, listed, URL_RULES, Scratch(spark, "op8")).select("row.page_id", "host", "path", "rule", "verdict")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the bigram model and under the unigram base."""
    return lm_scoring.score(table(spark, sf_dir, "documents"), Scratch(spark, "op9"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates in place of detected entities."""
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op10"), "stand-in key of the query")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector whitened along the four leading components of the distinct integer vectors."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), Scratch(spark, "op11"))
    return out.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_digits")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the fixed patterns, and runs that pass the randomness tests."""
    found = secret_scan.find(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op12"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = {k})) as bigint)").alias(f"n_{name}")
              for k, name in enumerate(secret_scan.KINDS[:3])]
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select("row.doc_id", *counts, F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
                        secret_scan.span_text("spans").alias("spans"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage: its faults, the cheapest audit and the repaired turns' hash."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    done = conversation_repair.repair(rows.where("code != 0"), Scratch(spark, "op13"))
    out = conversation_repair.digests(done).withColumnRenamed("conv", "conv_id")
    lost = rows.groupBy("conv_id").agg(F.max("code").alias("code")).where("code = 0")
    zero = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.unionByName(lost.select("conv_id", *zero, F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256")))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_packing": op2_packing,
    "op3_chat_format": op3_chat_format,
    "op4_ngram_join": op4_ngram_join,
    "op5_decontamination": op5_decontamination,
    "op6_warc": op6_warc,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filter": op8_url_filter,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_pii": op10_pii,
    "op11_whitening": op11_whitening,
    "op12_secret_scan": op12_secret_scan,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op6_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
h AS (SELECT payload_digest, max(page_id) AS holder FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN h.holder IS NULL OR h.holder = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN h.holder <> p.page_id THEN h.holder END AS refers_to
FROM p LEFT JOIN h ON p.payload_digest = h.payload_digest AND p.payload_bytes >= 1000""",
    "op8_url_filter": """
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN host LIKE 'ads%' OR (host <> '' AND length(host) % 5 = 0) THEN 'block' ELSE 'allow' END AS verdict
FROM r""",
}
