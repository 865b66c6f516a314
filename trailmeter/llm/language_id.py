"""Language identification by Bayesian fusion of evidence.

The likelihood of a text comes from byte trigrams; declared language, address suffix and host add what
grouped counts over the whole table say of them. A host's prior is smoothed towards its domain's, and that
towards the whole table's, so a host of few pages has little to say.

Nulls, ties and odd rows: missing text, declaration, suffix or host add no evidence; equal posteriors go to
the first language by name; repeated rows count and are returned once each; an empty table gives no rows;
a training table without labelled text leaves priors and declarations to decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmeter.llm.common import stored
from trailmeter.llm.shingles import pieces

BINS = 1 << 16
#: Labelled texts that the trigram model is fitted on, of each language at most.
SAMPLE = 1_500
#: Trigrams of one text count as so many independent ones at most.
INDEPENDENT = 60.0
#: Pseudo-rows of the parent in a host's and a domain's prior, and of chance in declarations.
HOST_WEIGHT, DOMAIN_WEIGHT, CHANCE = 20.0, 50.0, 5.0


def _trigrams(data: np.ndarray) -> np.ndarray:
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    code = lower[:-2] * np.uint32(65_599) + lower[1:-1] * np.uint32(2_654_435) + lower[2:] * np.uint32(40_503)
    return (code ^ (code >> np.uint32(13))) & np.uint32(BINS - 1)


def fitted(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities of trigram bins, from the sample of docs (doc_id, text, lang) whose
    ids have the smallest hashes. Counting is done by Spark; a language's counts are BINS numbers."""
    some = docs.where("text is not null and lang is not null").select("lang", "text", F.xxhash64("doc_id").alias("h"))
    counts = {r["lang"]: r["count"] for r in some.groupBy("lang").count().collect()}
    picked = None
    for lang, n in counts.items():
        part = some.where(F.col("lang") == lang)
        if n > sample:
            # The hash is uniform: so far down its range lie sample rows, about.
            part = part.where(F.col("h") < int(-(2**63) + sample / n * 2**64))
        picked = part if picked is None else picked.union(part)
    names = sorted(counts)
    if picked is None:
        return [], np.zeros((0, BINS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                bins = _trigrams(np.frombuffer(text.as_buffer(), np.uint8))
                total.setdefault(lang, np.zeros(BINS, np.int64))
                total[lang] += np.bincount(bins, minlength=BINS)
        for lang, values in total.items():
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(values[at])], ["lang", "bin", "n"]
            )

    cells = picked.select("lang", "text").mapInArrow(run, "lang string, bin long, n long")
    table = np.full((len(names), BINS), 0.5)
    for r in cells.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toLocalIterator():
        table[names.index(r["lang"]), r["bin"]] += r["n"]
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def _likelihoods(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """rows (key, text, ...) with ll, the tempered log likelihood of each language, instead of the text."""
    kept = [c for c in rows.columns if c != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            out = np.zeros((batch.num_rows, len(table)))
            for begin, end, data, offsets in pieces(batch.column(0)):
                if len(data) > 2:
                    bins = _trigrams(data)
                    # Sums to the end of each text; the two trigrams across its end are left out.
                    stop = np.maximum(offsets[1:] - 2, offsets[:-1])
                    size = np.maximum(stop - offsets[:-1], 1)
                    for k, row in enumerate(table):
                        total = np.r_[0.0, np.cumsum(row[bins], dtype=float)]
                        sums = total[np.minimum(stop, len(bins))] - total[np.minimum(offsets[:-1], len(bins))]
                        out[begin:end, k] = sums / size * np.minimum(size, INDEPENDENT)
            ll = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), max(1, len(table))) if len(table) else None
            ll = ll.cast(pa.list_(pa.float64())) if ll is not None else pa.array([[]] * batch.num_rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], ll], [*kept, "ll"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema.fields)
    return rows.select("text", *kept).mapInArrow(run, f"{schema}, ll array<double>")


def _best(values: Column) -> Column:
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def _counts(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Rows of each key by the language of their text: an array c."""
    per = [F.count_if(F.col("own") == k).cast("double") for k in range(n)]
    known = rows
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(F.array(*per).alias("c"))


def identified(rows: DataFrame, train: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """rows (text, host, domain, suffix, declared, and any keys) with lang and confidence, without the text.

    train (doc_id, text, lang) has the languages.
    """
    names, model = fitted(train, sample)
    n = len(names)
    scored = _likelihoods(rows, model)
    if not n:
        return scored.drop("ll").withColumns({"lang": F.col("declared"), "confidence": F.lit(0.0)})
    flat = F.array_max("ll") == F.array_min("ll")
    scored = stored(scored.withColumn("own", F.when(~flat, _best(F.col("ll")))))
    whole = scored.agg(*[F.count_if(F.col("own") == k) for k in range(n)]).first()
    total = sum(whole) or 1
    base = [(x + 1) / (total + n) for x in whole]
    prior = F.array(*map(F.lit, base))

    def shrunk(counts: Column, weight: float, parent: Column) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, parent, lambda x, p: (x + weight * p) / (size + weight))

    domains = _counts(scored, ["domain"], n).select("domain", shrunk(F.col("c"), DOMAIN_WEIGHT, prior).alias("dp"))
    hosts = _counts(scored, ["domain", "host"], n).join(domains, "domain")
    hosts = hosts.select("domain", "host", shrunk(F.col("c"), HOST_WEIGHT, F.col("dp")).alias("hp"))
    # What a declaration or suffix says: its share among each language's rows, against its share in all.
    def told(key: str, name: str) -> DataFrame:
        counts = _counts(scored, [key], n)
        size = F.aggregate("c", F.lit(0.0), lambda a, x: a + x)
        ratio = F.zip_with("c", prior, lambda x, p: F.log((x + CHANCE * p) / (size + CHANCE) / p))
        return counts.select(key, ratio.alias(name))

    out = scored.join(hosts, ["domain", "host"], "left")
    out = out.join(told("declared", "said"), "declared", "left").join(told("suffix", "ends"), "suffix", "left")
    zero = F.array_repeat(F.lit(0.0), n)
    logs = F.transform(F.coalesce("hp", prior), lambda p: F.log(p))
    for part in (F.col("ll"), F.coalesce("said", zero), F.coalesce("ends", zero)):
        logs = F.zip_with(logs, part, lambda x, y: x + y)
    out = out.withColumn("post", logs)
    top = F.array_max("post")
    mass = F.aggregate("post", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    lang = F.get(F.array(*map(F.lit, names)), _best(F.col("post")))
    keys = [c for c in rows.columns if c != "text"]
    return out.select(*keys, lang.alias("lang"), (1 / mass).alias("confidence"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """(text, page_id, host, domain, suffix, declared) from url and html."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    text = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1\\s*>|<[^>]*>", " ")
    none = lambda c: F.when(c != "", c)
    host = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    declared = F.lower(F.regexp_extract(html, "(?is)<html[^>]*\\blang\\s*=\\s*[\"']?([A-Za-z]{2,3})", 1))
    return pages.select(
        text.alias("text"),
        "page_id",
        none(host).alias("host"),
        none(F.substring_index(host, ".", -2)).alias("domain"),
        none(F.substring_index(host, ".", -1)).alias("suffix"),
        none(declared).alias("declared"),
    )
