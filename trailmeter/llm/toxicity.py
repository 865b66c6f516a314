"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two words adds up the triples of letters that both have in order, letters between them
allowed, each gap at a discount; so an insult with letters put in between is still near to itself. Word
ends count as letters. Landmarks are words of the labelled texts: those that tell toxic texts apart and a
sample of the others. The machine is linear in the kernel values at the landmarks, whitened by their own
kernel matrix. As the kernel is a product of triple counts, the landmarks' weights fold into one table of
triples, so scoring costs the same for any number of landmarks.

A text's score is a logistic curve over its worst word and the number of words beyond the margin.

Nulls, ties and odd rows: a null or empty text has the lowest score; labels of null count as no label, and
repeated labels once each; repeated documents are scored once for each row; without labels of both kinds all
scores are 0; extra columns are ignored. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmeter.llm.common import stored
from trailmeter.llm.shingles import mix

#: Labelled texts that are learned from: so many toxic and so many clean ones at most.
TOXIC_SAMPLE, CLEAN_SAMPLE = 2_000, 4_000
#: Landmarks of each kind, discount of a gap, bins of the triple table, letters of one piece of a word.
LANDMARKS, DISCOUNT, BINS, PIECE = 400, 0.7, 1 << 20, 30
#: Evidence (log likelihood ratio) that costs are measured by; examples of each kind at most.
EVIDENCE, EXAMPLES = 12.0, 12_000
#: Value from which a word counts as one of the worst.
MARGIN = 0.7
#: Words that a task remembers the values of.
REMEMBERED = 400_000
_GAPS = [(i, j) for j in range(2, 5) for i in range(1, j)]
_EDGES = string.punctuation + string.whitespace


def words_of(text: str | None) -> set[str]:
    return {w for w in (x.strip(_EDGES) for x in (text or "").lower().split()) if w}


def _cut(word: str) -> list[str]:
    """A long word in overlapping pieces."""
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bin, weight) of the letter triples of each word: arrays of one row a word, padded by weight 0."""
    wide = np.array(words, dtype=f"U{PIECE}").view(np.uint32).reshape(len(words), PIECE)
    length = np.array([min(len(w), PIECE) for w in words])
    letters = np.zeros((len(words), PIECE + 2), np.uint64)
    letters[:, 0] = 1
    letters[:, 1:-1] = wide
    letters[np.arange(len(words)), length + 1] = 2
    bins, weights = [], []
    for i, j in _GAPS:
        first, second, third = letters[:, :-j], letters[:, i : i - j], letters[:, j:]
        code = mix((first << np.uint64(42)) | (second << np.uint64(21)) | third)
        bins.append((code & np.uint64(BINS - 1)).astype(np.int64))
        there = np.arange(code.shape[1])[None, :] < (length + 2 - j)[:, None]
        weights.append(np.where(there, DISCOUNT ** (j - 2), 0.0).astype(np.float32))
    bins, weights = np.concatenate(bins, axis=1), np.concatenate(weights, axis=1)
    norm = np.sqrt((weights**2).sum(axis=1, keepdims=True))
    return bins, weights / np.maximum(norm, 1e-9)


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """Values between words, about 1 for a word and itself. Right words are done one at a time over a
    dense table, so memory is that of the left ones."""
    bins, weights = triples(left)
    out = np.zeros((len(left), len(right)))
    table = np.zeros(BINS, np.float32)
    other_bins, other_weights = triples(right)
    for k in range(len(right)):
        np.add.at(table, other_bins[k], other_weights[k])
        out[:, k] = (table[bins] * weights).sum(axis=1)
        table[other_bins[k]] = 0
    return out


def machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, by Newton steps; the last is the offset."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        inside = y * (x @ w) < 1
        part = x[inside] * cost[inside, None]
        new = np.linalg.solve(ridge + part.T @ x[inside], part.T @ y[inside])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


@dataclass
class Model:
    """Weight of each triple, offset, and the curve over worst word and words beyond the margin."""

    table: np.ndarray
    offset: float
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def values(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), -np.inf)
        cut = [(i, p) for i, w in enumerate(words) for p in _cut(w)]
        for a in range(0, len(cut), 8_192):
            part = cut[a : a + 8_192]
            bins, weights = triples([p for _, p in part])
            np.maximum.at(out, [i for i, _ in part], (self.table[bins] * weights).sum(axis=1) + self.offset)
        return out


def learned(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> Model | None:
    """A model of words from (word, toxic texts, clean texts) and the number of texts of each kind; None only
    without texts of both kinds.

    Words that are commoner in toxic texts are examples of them, each at a cost that grows with its evidence.
    As chance gives a word evidence e with probability exp(-e) at most, the cost falls with the share of words
    of that evidence or more that are so by chance, and with the share of clean texts.
    """
    if not toxic or not clean:
        return None
    share = toxic / (toxic + clean)

    def evidence(a: int, b: int) -> float:
        p = a / (a + b)
        gain = (a * math.log(p / share) if a else 0) + (b * math.log((1 - p) / (1 - share)) if b else 0)
        return gain if p > share else -gain

    judged = [(evidence(a, b), w, a, b) for w, a, b in counts]
    good = [x for x in judged if x[3] > 0 and x[0] < 2]
    bad = sorted((x for x in judged if x[0] > 0 and not (x[3] > 0 and x[0] < 2)), reverse=True)[:EXAMPLES]
    if not bad or not good:
        return Model(np.zeros(BINS, np.float32), 0.0)
    sure = [max(1 - len(judged) * math.exp(-e) / (k + 1), 0) for k, (e, *_) in enumerate(bad)]
    pure = [(a / toxic - b / clean) / (a / toxic + b / clean) for _, _, a, b in bad]
    trust = np.maximum(np.array(sure) * np.array(pure), 1e-3)
    order = mix(np.arange(len(good), dtype=np.uint64)).argsort()
    good = [good[i] for i in order[:EXAMPLES]]
    bad_words, good_words = [x[1][:PIECE] for x in bad], [x[1][:PIECE] for x in good]
    marks = bad_words[:LANDMARKS] + good_words[:LANDMARKS]
    own = kernel(marks, marks)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    keep = values > 1e-3
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    x = kernel(bad_words + good_words, marks) @ whiten
    y = np.r_[np.ones(len(bad_words)), -np.ones(len(good_words))]
    # The stronger the evidence for a word, the dearer it is to miss it.
    even = len(good_words) / trust.sum() / 4
    cost = trust * [even * e[0] / EVIDENCE / 4 for e in bad]
    w = machine(x, y, np.r_[np.clip(cost, trust / 10, 1_000), np.ones(len(good_words))])
    weight = whiten @ w[:-1]
    table = np.zeros(BINS, np.float32)
    bins, weights = triples(marks)
    for k in range(len(marks)):
        np.add.at(table, bins[k], weight[k] * weights[k])
    return Model(table, float(w[-1]))


def _measured(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """docs with worst (the highest value of a word) and beyond (words of more than MARGIN), not the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}
        for batch in batches:
            worst, beyond = [], []
            texts = batch.column(0)
            for a in range(0, batch.num_rows, 256):
                sets = [words_of(t.as_py()) for t in texts[a : a + 256]]
                if len(known) > REMEMBERED:
                    known.clear()
                new = list({w for s in sets for w in s if w not in known})
                known.update(zip(new, model.values(new).tolist(), strict=True))
                for s in sets:
                    values = [known[w] for w in s]
                    worst.append(max(values, default=-5.0))
                    beyond.append(sum(v > MARGIN for v in values))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(worst, pa.float64()), pa.array(beyond, pa.int64())],
                [*keep, "worst", "beyond"],
            )

    rows = docs.select("text", *keep)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{schema}, worst double, beyond long")


def _curve(rows: list) -> tuple[float, float, float]:
    """Logistic regression of toxic on worst and log(1 + beyond), rows weighted to their shares."""
    x = np.array([[r["worst"], math.log1p(r["beyond"]), 1.0] for r in rows])
    y, c = np.array([r["toxic"] for r in rows], float), np.array([r["share"] for r in rows], float)
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (c * (p - y)) + 0.1 * w
        w = w - np.linalg.solve((x * (c * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), slope)
    return tuple(w)


def _sampled(labelled: DataFrame, most: dict[int, int], counts: dict[int, int]) -> DataFrame:
    """Of each label the rows of smallest hash, about as many as wanted; share: rows that one stands for."""
    h = F.xxhash64("doc_id", F.lit(7))
    parts = []
    for toxic, n in counts.items():
        part, keep = labelled.where(F.col("toxic") == toxic), min(1.0, most[toxic] / n)
        if keep < 1:
            part = part.where(h < int(-(2**63) + keep * 2**64))
        parts.append(part.withColumn("share", F.lit(1 / keep)))
    return parts[0].union(parts[1])


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs (doc_id, text); labels (doc_id, toxic).

    Documents whose crc32 of the id as text is divisible by folds are held out of all learning.
    """
    fold = F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")), F.lit(folds))
    known = labels.where("toxic in (0, 1)").where(fold != 0).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    model = None
    if len(counts) == 2:
        picked = _sampled(known, {1: TOXIC_SAMPLE, 0: CLEAN_SAMPLE}, counts)
        # The sample is bounded by its two parameters, whatever the tables hold.
        sample = stored(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").drop("doc_id"))
        tokens = F.split(F.lower(F.coalesce("text", F.lit(""))), "\\s+")
        trimmed = F.transform(tokens, lambda w: F.regexp_replace(w, "^\\p{Punct}+|\\p{Punct}+$", ""))
        each = sample.select("toxic", F.explode(F.array_distinct(trimmed)).alias("w")).where("w <> ''")
        table = each.groupBy("w").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
        sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
        least = min(3, *sizes.values()) if len(sizes) == 2 else 3
        table = [(r["w"], r["a"], r["b"]) for r in table.where(F.expr("a + b") >= least).toLocalIterator()]
        if len(sizes) == 2:
            model = learned(table, sizes[1], sizes[0])
        if model is not None:
            model.curve = _curve(_measured(sample, model, ["toxic", "share"]).collect())
    out = docs.select("doc_id", "text", (fold == 0).alias("held_out"))
    if model is None:
        scored = out.withColumn("score", F.lit(0.0))
    else:
        a, b, c = model.curve
        line = a * F.col("worst") + b * F.log1p("beyond") + c
        scored = _measured(out, model, ["doc_id", "held_out"]).withColumn("score", 1 / (1 + F.exp(-line)))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
