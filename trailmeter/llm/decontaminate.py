"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ from a passage by an error budget of k edits. Cut into k + 1
pieces, one of them must then occur unchanged: an Aho-Corasick automaton finds all exact piece hits in
one pass over a text, and Myers' bit-parallel distance verifies the text around each hit.

Texts and items are compared in lower case with runs of white space as one space. Nulls, ties and odd
rows: a null or empty text has no hits; items without a character match nothing, equal items are found
each under its own id; repeated documents are reported once for each row; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed for each character of an item.
RATE = 0.08
#: Characters of test items that one pass holds in memory; more items take more passes.
PASS_CHARS = 8_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(m: int, rate: float) -> int:
    return int(m * rate)


def cut(text: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 pieces of about equal length."""
    ends = [len(text) * i // (k + 1) for i in range(k + 2)]
    return [(a, text[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True) if a < b]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def distance(at: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of text, and where the first such part ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = at.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """All items of one pass: their pieces in one automaton, their bit masks for verification."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            text = normal(text)
            if text:
                k = budget(len(text), rate)
                for offset, piece in cut(text, k):
                    places.setdefault(piece, []).append((len(self.items), offset))
                self.items.append((item, len(text), k, masks(text)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def hits(self, text: str | None) -> dict[int, int]:
        """Item to least distance, for the items within their budget of some part of the text."""
        text, best, tried = normal(text), {}, {}
        if not self.items or not text:
            return {}
        for last, (size, where) in self.automaton.iter(text):
            for i, offset in where:
                item, m, k, at = self.items[i]
                start = last + 1 - size - offset
                # Hits of one passage differ in place by the budget at most: one wide look is enough.
                if 0 <= start - tried.get(i, -math.inf) <= k:
                    continue
                tried[i] = start
                found, _ = distance(at, m, text[max(0, start - k) : start + m + 2 * k])
                if found <= k:
                    best[item] = min(found, best.get(item, found))
        return best


def _passes(items: DataFrame) -> list[Broadcast]:
    """The test items in parts of about PASS_CHARS letters."""
    spark = items.sparkSession
    some = items.where("text is not null").select("item_id", "text")
    size = some.agg(F.sum(F.char_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(size / PASS_CHARS))
    parts = [some.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i) for i in range(passes)]
    return [spark.sparkContext.broadcast([(r.item_id, r.text) for r in p.toLocalIterator()]) for p in parts]


def contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance) of each document row and test item that it holds within the budget."""
    out = None
    for shared in _passes(items):

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                rows = [
                    (doc, item, d)
                    for doc, text in zip(batch["doc_id"], batch["text"], strict=True)
                    for item, d in matcher.hits(text).items()
                ]
                frame = pd.DataFrame(rows, columns=["doc_id", "item_id", "distance"])
                yield frame.astype({"doc_id": "Int64", "item_id": "Int64", "distance": "int64"})

        found = docs.select("doc_id", "text").mapInPandas(run, "doc_id long, item_id long, distance long")
        out = found if out is None else out.union(found)
    return out


def decontaminated(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of docs that hold no test item within its budget, each judged where it lies."""
    place = docs.columns.index("text")
    for shared in _passes(items):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                clean = [not matcher.hits(text.as_py()) for text in batch.column(place)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
