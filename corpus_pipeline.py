"""The corpus pipeline: operators of trailmeter.llm in stages, from documents to packed sequences.

A stage takes what its predecessor wrote, so the folders that a stage needs in between are deleted when the
next one begins, unless its input still reads them.

Nulls, ties and odd rows: a row is judged by itself, whether or not it has an id or shares it. A null or empty
text fails the quality rules; of near duplicates the row of the smallest id stays (rows without id come
last, and of equal ids any one stays); decontamination and the secret scan leave null texts as they are;
an empty table gives none; columns beside those of documents are dropped.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmeter.llm.common import collected, removed, stored, table
from trailmeter.llm.decontaminate import decontaminated
from trailmeter.llm.near_dedup import near_duplicates
from trailmeter.llm.packing import packed
from trailmeter.llm.quality import passed
from trailmeter.llm.secret_scan import redacted

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_earlier: list[str] = []


def _stage(function: Stage) -> Stage:
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = " ".join(docs.inputFiles())
        for path in [p for p in _earlier if p.rsplit("/", 1)[-1] not in read]:
            removed(spark, path)
            _earlier.remove(path)
        with collected() as made:
            out = function(spark, docs.select(*COLUMNS), sf_dir)
        _earlier.extend(made)
        return out

    return run


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the outlier verdict rejects go."""
    return passed(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, the one of the smallest id. Rows get a key of their
    own, stored so that a lost task gives no other; only the keys of rows that go are joined with texts."""
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()))
    group = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"))
    group = stored(group.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("group")))
    several = group.groupBy("group").agg(F.count("_row").alias("n")).where("n > 1").select("group")
    group = group.join(several, "group").join(rows.select("_row", "doc_id"), "_row")
    group = stored(group.withColumn("rank", F.struct(F.col("doc_id").isNull(), "doc_id", "_row")))
    stays = group.groupBy("group").agg(F.min("rank").alias("least")).select("group", "least")
    gone = group.join(stays, "group").where(~F.col("rank").eqNullSafe(F.col("least"))).select("_row")
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are masked; the number of characters follows the new text."""
    changed = ~F.col("text").eqNullSafe(F.col("_before"))
    clean = redacted(docs.withColumn("_before", F.col("text")))
    n_chars = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*COLUMNS)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents left, as pieces of packed sequences."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Estimates, sketches and linear programs are beyond SQL; tests/llm checks stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each result is stored, and deleted once the next one is."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            with collected() as now:
                docs = stored(docs)
            for path in before:
                removed(spark, path)
            before = now
    return docs
