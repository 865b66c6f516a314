"""The registered queries of this package, with production parameters, over whole tables.

SQL can state what the joins and the trie return (llm/oracle.py), though not how; register likelihoods,
kernels, concentration steps, linear programs, state and tokenizers are beyond it, and tests/llm checks
those on small fixtures.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmeter.llm.alignment import token_alignment
from trailmeter.llm.common import scratch_dir, table
from trailmeter.llm.decontaminate import contaminated
from trailmeter.llm.language_id import identified, page_evidence
from trailmeter.llm.near_dedup import near_duplicates
from trailmeter.llm.oracle import ORACLE
from trailmeter.llm.packing import packed, vocabulary
from trailmeter.llm.prefix_trie import prefix_trie
from trailmeter.llm.quality import quality
from trailmeter.llm.secret_scan import secrets
from trailmeter.llm.shards import sharded
from trailmeter.llm.signature_tree import signature_join
from trailmeter.llm.substring_dedup import RUN_WORDS, repeated
from trailmeter.llm.token_counts import Rollup, bpe_counts, word_counts
from trailmeter.llm.toxicity import toxicity


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans that are removed, and the document in which the first unit of each stays."""
    return repeated(table(spark, sf_dir, "documents"), run_words=RUN_WORDS)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents")).drop("found", "text_hash")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come with word counts, are counted anew by a tokenizer, and lose exact copies."""
    docs = table(spark, sf_dir, "documents")
    rollup = Rollup(spark, f"{scratch_dir(spark)}/{uuid.uuid4().hex}")
    rollup.commit(1, word_counts(docs).withColumn("op", F.lit("insert")))
    rollup.commit(2, bpe_counts(docs, vocabulary()).withColumn("op", F.lit("revise")))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"))
    first = hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    copies = hashed.join(first, ["h1", "h2"]).where("doc_id > first")
    copies = copies.select("doc_id", F.col("h1").alias("digest"), F.lit("delete").alias("op"))
    unknown = {k: F.lit(None).cast("string") for k in ("source", "lang", "version")}
    rollup.commit(3, copies.withColumns({**unknown, "tokens": F.lit(0).cast("long")}))
    return rollup.totals()


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages by text, declared language, suffix and host, and all documents by text and source."""
    docs = table(spark, sf_dir, "documents")
    pages = page_evidence(table(spark, sf_dir, "pages")).withColumn("doc_id", F.lit(None).cast("long"))
    none = F.lit(None).cast("string")
    texts = docs.select(
        "text",
        F.lit(None).cast("long").alias("page_id"),
        F.col("source").alias("host"),
        F.lit("documents").alias("domain"),
        none.alias("suffix"),
        none.alias("declared"),
        "doc_id",
    )
    return identified(pages.unionByName(texts), docs).withColumn("kept", F.col("confidence") >= 0.5)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents"))


__all__ = ["ORACLE", "QUERIES"]

QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup,
        op2_toxicity,
        op3_quality,
        op4_substring_dedup,
        op5_secrets,
        op6_packing,
        op7_sharding,
        op8_decontamination,
        op9_token_counts,
        op10_language_id,
        op11_prefix_trie,
        op12_signature_join,
        op13_alignment,
    )
}
