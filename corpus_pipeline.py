"""Corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, surrogates
for personal data, packing.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``docs``.  Stage by stage:

* quality rules: documents that the base rules or the learned decision list reject go.  Null and
  empty texts fail the base rules.
* n-gram Jaccard join: of each group of rows whose texts are linked the one with the smallest id
  stays (null ids last; ties: smallest other columns).  Ids link nothing: unlike texts that share
  an id all stay, and rows with a null id are compared like others.
* decontamination: documents that leak an item of ``benchmark`` go.
* PII: the text of every document with mentions is rewritten, and ``n_chars``, where present,
  follows it.
* packing: the pieces of all documents that are left, with their sequence and offset.

Empty tables pass through every stage; extra columns are kept up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.llm import decontamination, ngram_join, packing, pii, quality_rules
from demandflow.llm.common import Scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "quality")
    stats = quality_rules.with_statistics(docs.select("doc_id", "text"))
    stats = scratch.write(stats.select("row.doc_id", *quality_rules.STATISTICS, "base_failed"), "statistics")
    rules = quality_rules.learn(stats, table(spark, sf_dir, "labels"), scratch)
    scratch.drop(stats)
    return quality_rules.keep(docs, rules)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "near")

    def orderable(c: str, of: str = "") -> Column:
        """Columns that Spark cannot compare or hash (maps, at any depth) stand as text."""
        return F.to_json(F.struct(f"{of}`{c}`")) if "map<" in docs.schema[c].dataType.simpleString() else F.col(f"{of}`{c}`")

    values = [orderable(c) for c in docs.columns]
    # rows are linked by numbers of their own, not by their ids; wholly equal rows share them.
    # One number joins, the other tells rows apart that share it by chance
    numbers = [F.xxhash64(*values).alias("number"), F.xxhash64(F.lit(1), *reversed(values)).alias("check")]
    numbered = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *numbers)
    texts = numbered.where("row.text IS NOT NULL").select(F.col("number").alias("doc_id"), "row.text")
    found = ngram_join.clusters(texts, scratch).where("n_shingles > 0")
    # the short list of rows in groups of two or more, without their texts
    several = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
    members = found.select(F.col("doc_id").alias("number"), "component_id").distinct().join(several, "component_id")
    members = scratch.write(members, "members")
    # rows that a bitmap of the list does not hold stay where they are, the joins move the others only
    listed = ngram_join.bitmap(members.select(F.col("number").alias("h")), members.count())
    numbered = numbered.withColumn("maybe", F.col("row.text").isNotNull() & ngram_join.maybe(spark, F.col("number"), *listed))
    likely = scratch.write(numbered.where("maybe").drop("maybe"), "likely")
    others = [orderable(c, "row.").alias(f"o{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")]
    order = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), *others)
    keyed = likely.select(order.alias("o"), "number", "check")
    group = scratch.write(keyed.join(members, "number").groupBy("component_id", "number", "check").agg(
        F.min("o").alias("o"), F.count(F.lit(1)).alias("n")), "group")
    first = group.groupBy("component_id").agg(F.min(F.struct("o", "number", "check", "n")).alias("x")).select("x.number", "x.check", "x.n")
    first = scratch.write(first, "first")
    # rows of a group go, but for the first; if that one occurs several times, one of them stays
    once = group.select("number", "check").join(first.where("n = 1"), ["number", "check"], "left_anti")
    alone = likely.join(once, ["number", "check"], "left_anti").select("row.*")
    again = likely.join(first.where("n > 1").select("number", "check"), ["number", "check"], "left_semi").dropDuplicates(["number", "check"])
    return numbered.where("NOT maybe").select("row.*").unionByName(alone).unionByName(again.select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "clean"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # behind a struct, no column of the documents can clash with those of the operator
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    out = pii.replace(docs.select("doc_id", "text", row.alias("row")), Scratch(spark, "pii"), "stand-in key of the pipeline")
    chars = F.when(F.col("n_entities") > 0, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None
    new = {"text": F.col("text"), "n_chars": chars}
    return out.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    parts = packing.pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(parts, Scratch(spark, "pack"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("ngram_join", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("packing", pack),
]

#: Learned rules, component search, tiling and tokenising are not SQL: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = scratch.write(stage(spark, docs, sf_dir), name)
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
