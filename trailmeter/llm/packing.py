"""Packing by cutting-stock column generation.

A document's ids are cut into full sequences and a remainder. Remainders are counted by length; a linear
program over patterns, whose columns a knapsack dynamic program prices, says how often each pattern of
lengths is used. Patterns are rounded down, the few pieces left are packed first-fit, and ranked pieces
take the places of their length.

Nulls, ties and odd rows: a null text is empty and has the end id alone; equal texts and repeated rows are
packed once each; rows without id are packed too; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import importlib
import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmeter.llm.common import ranked, stored

LENGTH, END = 2048, 1
#: Lengths are rounded up to this many ids in the linear program, so it has 128 rows at most.
UNIT = 16
#: Rows that one window of ranks holds, about.
CHUNK_ROWS = 50_000
_encoders: dict[str, object] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    return importlib.import_module("public_tokenizers").path(name)


def encoder(path: str):
    """A byte-level BPE of a tokenizers file, as merge ranks for tiktoken.

    Ids are those that the tokenizers library gives with add_special_tokens=False, where the strings of
    special tokens in a text become those tokens; this one takes a sixth of the time.
    """
    if path not in _encoders:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        letters = {c: b for b, c in _byte_letters().items()}
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in model["model"]["vocab"].items()
            if token not in special
        }
        pattern = importlib.import_module("public_tokenizers").PATTERN
        _encoders[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[path]


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: bytes that print stand
    for themselves, the others follow from 256 on in order."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}


def pieces_of(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): full sequences and one remainder of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for i, text in enumerate(batch.column(1)):
                ids = np.array([*code.encode(text.as_py() or "", allowed_special="all"), END], "<u4")
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    for column, value in zip(rows, (i, start, len(part), zlib.crc32(part.tobytes()), len(ids)), strict=True):
                        column.append(value)
            arrays = [pa.array(x, pa.int64()) for x in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(arrays[0]), *arrays[1:]],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select("doc_id", "text").mapInArrow(run, kind)


def knapsack(sizes: np.ndarray, worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Most worth that fits the room, any number of each size, and how many of each."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        best[c], choice[c] = best[c - 1], -1
        fits = np.flatnonzero(sizes <= c)
        if len(fits):
            values = best[c - sizes[fits]] + worth[fits]
            top = int(values.argmax())
            if values[top] > best[c] + 1e-12:
                best[c], choice[c] = values[top], fits[top]
    counts, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[choice[c]] += 1
            c -= sizes[choice[c]]
    return float(best[room]), counts


def patterns(demand: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """(how many of each size, how often) so that all demand has a place: few sequences in all."""
    sizes = np.array(sorted(demand), np.int64)
    need = np.array([demand[s] for s in sizes], float)
    if not len(sizes):
        return []
    basis = np.diag((room // sizes).astype(float))
    # Each step swaps one pattern; the bound only guards against cycles of equal steps.
    for _ in range(40 * len(sizes) + 400):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, column = knapsack(sizes, prices, room)
        if value <= 1 + 1e-9:
            break
        used, way = np.linalg.solve(basis, need), np.linalg.solve(basis, column.astype(float))
        ratio = np.where(way > 1e-9, np.maximum(used, 0) / np.where(way > 1e-9, way, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    used = np.floor(np.maximum(np.linalg.solve(basis, need), 0) + 1e-9).astype(np.int64)
    out, left = [], need.astype(np.int64)
    for column, times in zip(basis.T.astype(np.int64), used, strict=True):
        if times:
            out.append(({int(s): int(n) for s, n in zip(sizes, column, strict=True) if n}, int(times)))
            left = left - column * times
    # First-fit decreasing for what rounding left: a few pieces a size at most.
    bins: list[tuple[list[int], int]] = []
    for size, count in sorted(zip(sizes.tolist(), left.tolist(), strict=True), reverse=True):
        for _ in range(max(0, count)):
            i = next((i for i, (_, free) in enumerate(bins) if free >= size), None)
            if i is None:
                bins.append(([size], room - size))
            else:
                bins[i] = ([*bins[i][0], size], bins[i][1] - size)
    return out + [({s: held.count(s) for s in held}, 1) for held, _ in bins]


def packed(docs: DataFrame, path: str | None = None, length: int = LENGTH, unit: int = UNIT) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for each piece of docs.

    The histogram has length / unit rows at most and is all that the driver sees. Ranks inside a length
    are counted chunk by chunk, so one length may hold any share of the pieces.
    """
    pieces = stored(pieces_of(docs, path or vocabulary(), length))
    pieces = pieces.withColumn("bin", F.ceil(F.col("length") / unit).cast("long"))
    pieces = pieces.withColumn("bin", F.when(F.col("length") == length, F.lit(0)).otherwise(F.col("bin")))
    histogram = {r["bin"]: r["count"] for r in pieces.groupBy("bin").count().collect()}
    chunks = max(1, math.ceil(sum(histogram.values()) / CHUNK_ROWS))
    chunk = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(chunks))
    order = [F.col(c) for c in ("doc_id", "start", "ids_crc32")]
    placed = ranked(pieces, ["bin"], order, "rank", chunk, chunks)
    # Places of a size, in order: from that rank on, so many in each sequence, from that sequence on.
    runs: list[tuple[int, int, int, int]] = []
    reached: dict[int, int] = {}
    sequences = 0
    for counts, times in patterns({b: n for b, n in histogram.items() if b}, length // unit):
        for size, each in counts.items():
            runs.append((size, reached.get(size, 0), each, sequences))
            reached[size] = reached.get(size, 0) + each * times
        sequences += times
    runs.append((0, 0, 1, sequences))
    runs.sort()
    size, first, each, base = (np.array(x, np.int64) for x in zip(*runs, strict=True))
    keys = size.astype(float) * 2.0**40 + first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("bin", "rank"))
            i = np.searchsorted(keys, held.astype(float) * 2.0**40 + rank, "right") - 1
            sequence = base[i] + (rank - first[i]) // each[i]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in out]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence)], [*out, "sequence_id"])

    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    kind = ", ".join(f"{c} long" for c in [*out, "sequence_id"])
    # A sequence holds length pieces at most.
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order)
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return placed.mapInArrow(run, kind).withColumn("offset", F.coalesce(before, F.lit(0)))
