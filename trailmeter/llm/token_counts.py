"""Token counts as delta-maintained rollups.

A batch of signed changes (insert, delete, revise) becomes additive deltas: what the ledger so far holds of
a changed document counts negative, its new count positive. Each batch owns one folder of the ledger and
one of the rollup; committing it again overwrites just these, so totals are the same after any number of
retries. Totals add up a few rows for each batch, never the documents.

Ledger and rollup of a batch are written before its mark, an empty file in the folder of marks. Marks are listed
when a rollup is opened, so what is committed is known from storage; a batch without a mark is committed anew.

A document is its id and, if given, a digest of its text; it may have several copies, which all count. In a
batch, changes follow their number (seq, 0 if not given), and of equal numbers inserts come before revisions
and those before deletes. An insert adds a copy; a revision gives all copies so far its counts (of several
of one number the largest counts win, and a document without a copy gets one); a delete takes all copies.
The ledger is dealt over PARTS folders by document, so a small batch reads the folders of its documents only;
compact() adds up the ledger of all batches so far.

Nulls, ties and odd rows: null sources and languages are groups of their own; rows without id are copies of
one document per digest, and each is counted; a delete of an unknown document does nothing; empty batches are
committed as such; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmeter.llm.common import stored
from trailmeter.llm.packing import encoder

GROUP = ["source", "lang", "version"]
KEY = ["doc_id", "digest"]
#: Folders of a batch's ledger.
PARTS = 64
LEDGER = "doc_id long, digest long, source string, lang string, version string, tokens long, docs long, part int"
ROLLUP = "source string, lang string, version string, tokens long, docs long"


def word_counts(docs: DataFrame, version: str = "words-1") -> DataFrame:
    """(doc_id, digest, source, lang, version, tokens) by white space."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    digest = F.xxhash64("text").alias("digest")
    return docs.select("doc_id", digest, "source", "lang", F.lit(version).alias("version"), F.size(words).cast("long").alias("tokens"))


def bpe_counts(docs: DataFrame, path: str, version: str = "byte_bpe_50k-1") -> DataFrame:
    """(doc_id, digest, source, lang, version, tokens) by a byte-level BPE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            counts = [len(code.encode(t.as_py() or "", allowed_special="all")) for t in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(counts, pa.int64())], ["doc_id", "digest", "source", "lang", "tokens"]
            )

    counted = docs.select("doc_id", F.xxhash64("text").alias("digest"), "source", "lang", "text").mapInArrow(
        run, "doc_id long, digest long, source string, lang string, tokens long"
    )
    return counted.withColumn("version", F.lit(version))


def _part() -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(PARTS)).cast("int")


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """left join right on the document, whose parts may be null."""
    renamed = right.withColumnsRenamed({c: f"_of_{c}" for c in KEY})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in KEY]
    return left.join(renamed, same, how).drop(*[f"_of_{c}" for c in KEY])


class Rollup:
    """A ledger and its rollup in a shared folder; batches are committed in order of their numbers."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.batches, self.base = spark, folder, set(), None
        marks = self._path("marks")
        files = marks.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(marks):
            names = [f.getPath().getName() for f in files.listStatus(marks)]
            self.batches = {int(n) for n in names if n.isdigit()}
            self.base = max((int(n[5:]) for n in names if n.startswith("base-")), default=None)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _mark(self, batch: int, done: bool) -> None:
        """Set or take away a batch's mark; taken away before its folders are written again."""
        path = self._path(f"marks/{batch}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if done:
            files.create(path, True).close()
            self.batches.add(batch)
        else:
            files.delete(path, False)
            self.batches.discard(batch)

    def _read(self, name: str, schema: str, batches: list) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        # Each batch is a table with folders of its own.
        read = self.spark.read.schema(schema)
        return reduce(DataFrame.unionByName, [read.parquet(f"{self.folder}/{name}/{b}") for b in batches])

    def _ledger(self, before: int) -> DataFrame:
        """What is known of documents before a batch: the last compacted ledger and the batches after it."""
        base = [] if self.base is None else [f"base-{self.base}"]
        later = sorted(b for b in self.batches if b < before and (self.base is None or b > self.base))
        return self._read("ledger", LEDGER, [*base, *later])

    def commit(self, batch: int, changes: DataFrame) -> None:
        """changes: op (insert, delete, revise), doc_id, source, lang, version, tokens, and if they are there
        digest (a long) and seq (the order of changes)."""
        later = [b for b in self.batches if b > batch]
        if later or (self.base is not None and batch <= self.base):
            raise ValueError(f"batch {batch} is older than committed {sorted(later) or self.base}")
        for name, value in (("digest", None), ("seq", 0)):
            if name not in changes.columns:
                changes = changes.withColumn(name, F.lit(value))
        columns = [F.col("op"), *[F.col(c).cast("long").alias(c) for c in (*KEY, "seq")], *GROUP, F.col("tokens")]
        # Equal changes are one row before the shuffle. Stored, as counting tokens is the most of the work.
        one = changes.select(*columns).groupBy("op", *KEY, "seq", *GROUP, "tokens")
        one = stored(one.agg(F.count(F.lit(1)).alias("n")).withColumn("part", _part()))
        parts = [r["part"] for r in one.select("part").distinct().limit(PARTS).collect()]
        is_op = {op: F.col("op") == op for op in ("insert", "revise", "delete")}
        counts = F.struct("seq", "tokens", *GROUP)
        ends = one.groupBy(*KEY).agg(
            F.max(F.when(is_op["delete"], F.col("seq"))).alias("_end"),
            F.max(F.when(is_op["revise"], counts)).alias("_new"),
        )
        # What a delete takes away, a revision before it included, has no effect.
        void = F.col("_new.seq") <= F.col("_end")
        ends = ends.withColumn("_new", F.when(F.coalesce(void, F.lit(False)), None).otherwise(F.col("_new")))
        # Only the documents of the batch are added up.
        held = _same(self._ledger(batch).where(F.col("part").isin(parts)), ends.select(*KEY), "left_semi")
        held = held.groupBy(*KEY, *GROUP).agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
        held = stored(held.where("docs <> 0"))
        changed = ends.where("_end is not null or _new is not null")
        gone = _same(held, changed, "inner").select(
            *KEY, *GROUP, (-F.col("tokens")).alias("tokens"), (-F.col("docs")).alias("docs")
        )
        alive = _same(one.where(is_op["insert"]), ends, "inner").where("_end is null or seq > _end")
        taken = F.coalesce(F.col("seq") <= F.col("_new.seq"), F.lit(False))
        fresh = alive.where(~taken).select(*KEY, *GROUP, (F.col("tokens") * F.col("n")).alias("tokens"), F.col("n").alias("docs"))
        # A revision takes the copies held, unless they are deleted, and those inserted before it.
        kept = _same(held, changed, "inner").where("_end is null").select(*KEY, F.col("docs").alias("n"))
        copies = kept.unionByName(alive.where(taken).select(*KEY, "n")).groupBy(*KEY).agg(F.sum("n").alias("n"))
        revised = _same(ends.where("_new is not null"), copies, "left").withColumn("n", F.coalesce("n", F.lit(1)))
        revised = revised.select(
            *KEY, *[F.col(f"_new.{c}") for c in GROUP], (F.col("_new.tokens") * F.col("n")).alias("tokens"), F.col("n").alias("docs")
        )
        self._mark(batch, False)
        delta = gone.unionByName(fresh).unionByName(revised).withColumn("part", _part())
        delta.write.mode("overwrite").partitionBy("part").parquet(f"{self.folder}/ledger/{batch}")
        delta = self._read("ledger", LEDGER, [batch]).groupBy(*GROUP)
        delta = delta.agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
        delta.write.mode("overwrite").parquet(f"{self.folder}/rollup/{batch}")
        self._mark(batch, True)

    def compact(self) -> None:
        """Add up the ledger of all batches so far; these can't be committed again."""
        if not self.batches or max(self.batches) == self.base:
            return
        last = max(self.batches)
        rows = self._ledger(last + 1).groupBy(*KEY, *GROUP, "part")
        rows = rows.agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")).where("docs <> 0 or tokens <> 0")
        rows.write.mode("overwrite").partitionBy("part").parquet(f"{self.folder}/ledger/base-{last}")
        path = self._path(f"marks/base-{last}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True).close()
        self.base = last

    def totals(self) -> DataFrame:
        """(source, lang, version, tokens, docs) of all batches."""
        rows = self._read("rollup", ROLLUP, sorted(self.batches)).groupBy(*GROUP)
        return rows.agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")).where("docs <> 0 or tokens <> 0")
