"""Sharding by a k-d tree with distributed weighted medians.

A node of s shards is split along its widest metadata dimension, where the bytes to the left are nearest
to floor(s / 2) / s of its own, until every leaf is one shard. A split point is found by histograms:
each pass counts the bytes of 16,384 cells of the range in question for all nodes of a level at once, and
goes on inside the cell that holds the point. Ties of a dimension are ordered by the text's checksum
and then the id, so equal texts lie together and are only cut where a split falls into them. Only
DataFrame functions are used; the driver sees a row for each node.

Nulls, ties and odd rows: a null text counts as empty, null languages and ids have places of their own;
fully equal rows stay together; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmeter.llm.common import ranked, stored

CELLS = 16_384
#: Share of a shard's bytes that a split may be off.
TOLERANCE = 0.001
#: Rows that one window of slot numbers holds, about.
CHUNK_ROWS = 50_000


@dataclass
class Split:
    """Where a node of shards from first on is cut: rows whose keys are up to cut, in order, go left."""

    first: int
    shards: int
    aim: float
    bound: float
    dim: int
    ends: list[tuple[int, int]]
    before: int = 0
    cut: list[int] = field(default_factory=list)
    done: bool = False

    def __post_init__(self) -> None:
        self.low, self.high = self.ends[0]

    @property
    def step(self) -> int:
        return (self.high - self.low) // CELLS + 1

    def narrow(self, cell: int, weight: int, upto: int) -> None:
        """Go on inside the cell that holds the aim, or end at its nearer side if that is near enough."""
        low = self.low + cell * self.step
        high = min(self.high, low + self.step - 1)
        left, right = self.before + upto - weight, self.before + upto
        level = len(self.cut)
        if (low == high and level == 2) or min(right - self.aim, self.aim - left) <= self.bound:
            # Below the least long there is no value to cut at.
            after = right - self.aim <= self.aim - left or low == -(2**63)
            self.cut.append(high if after else low - 1)
            self.done = True
            return
        self.before = left
        if low < high:
            self.low, self.high = low, high
        else:
            self.cut.append(low)
            self.low, self.high = self.ends[level + 1]


def _key(dims: list[str]) -> Column:
    """The first key of a row in its node's split, by the number of the dimension."""
    out = F.col(dims[-1])
    for i, d in enumerate(dims[:-1]):
        out = F.when(F.col("dim") == i, F.col(d)).otherwise(out)
    return out


def _with(rows: DataFrame, table: list[tuple], schema: str) -> DataFrame:
    """Rows with what the driver knows of their node: a row for each node, so one a shard at most."""
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(table, schema)), "node")


def _cuts(placed: DataFrame, splits: dict[int, Split], dims: list[str]) -> None:
    """Find the cut of every split, a pass of histograms for all of them at a time."""
    while left := [x for x in splits.values() if not x.done]:
        table = [
            (x.first, x.dim, len(x.cut), *[*x.cut, 0, 0][:2], x.low, x.high, x.step, float(x.aim - x.before))
            for x in left
        ]
        known = _with(
            placed,
            table,
            "node int, dim int, level int, c0 long, c1 long, low long, high long, step long, aim double",
        )
        key = F.when(F.col("level") == 0, _key(dims)).when(F.col("level") == 1, F.col("crc"))
        known = known.withColumn("key", key.otherwise(F.col("id")))
        same = (F.col("level") == 0) | (_key(dims) == F.col("c0"))
        same = same & ((F.col("level") < 2) | (F.col("crc") == F.col("c1")))
        # In decimals, as the difference of two ids may pass a long.
        far = F.expr("floor((cast(key as decimal(20,0)) - low) / cast(step as decimal(20,0)))").cast("long")
        cells = known.where(same & F.col("key").between(F.col("low"), F.col("high")))
        cells = cells.groupBy("node", "aim", far.alias("cell")).agg(F.sum("size").alias("w"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("cell"))
        cells = cells.withColumn("upto", upto).where("upto >= aim")
        for r in cells.groupBy("node").agg(F.min(F.struct("cell", "w", "upto")).alias("s")).collect():
            splits[r["node"]].narrow(*r["s"])


def _leaves(rows: DataFrame, shards: int, dims: list[str], tolerance: float) -> DataFrame:
    """rows with node: the shard of each row."""
    keys = [*dims, "crc", "id"]
    ends = [f(k).alias(f"{name}_{k}") for k in keys for name, f in (("lo", F.min), ("hi", F.max))]
    placed = rows.withColumn("node", F.lit(0))
    sizes, widths = {0: shards}, {}
    while any(n > 1 for n in sizes.values()):
        seen = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("size").alias("w"), *ends).collect()}
        if not seen:
            break
        widths = widths or {d: max(1, seen[0][f"hi_{d}"] - seen[0][f"lo_{d}"]) for d in dims}
        splits = {}
        for first, r in seen.items():
            if (n := sizes[first]) > 1:
                wide = max(range(len(dims)), key=lambda i: (r[f"hi_{dims[i]}"] - r[f"lo_{dims[i]}"]) / widths[dims[i]])
                order = [(r[f"lo_{k}"], r[f"hi_{k}"]) for k in (dims[wide], "crc", "id")]
                splits[first] = Split(first, n, r["w"] * (n // 2) / n, tolerance * r["w"] / n, wide, order)
        _cuts(placed, splits, dims)
        table = []
        for first, n in list(sizes.items()):
            cut = splits[first].cut if first in splits else []
            move = n // 2 if cut else 0
            # Without a further cut, all rows of the last key's value are alike.
            table.append((first, splits[first].dim if cut else 0, len(cut), *[*cut, 0, 0, 0][:3], move))
            if n > 1:
                sizes[first], sizes[first + n // 2] = n // 2, n - n // 2
        known = _with(placed, table, "node int, dim int, level int, c0 long, c1 long, c2 long, move int")
        first, crc, row = _key(dims), F.col("crc"), F.col("id")
        c0, c1, c2, level = (F.col(c) for c in ("c0", "c1", "c2", "level"))
        left = (first < c0) | ((first == c0) & ((level == 1) | (crc < c1) | ((crc == c1) & ((level == 2) | (row <= c2)))))
        node = (F.col("node") + F.when(left | (level == 0), 0).otherwise(F.col("move"))).cast("int")
        placed = stored(known.select(node.alias("node"), *rows.columns))
    return placed


def sharded(docs: DataFrame, shards: int = 40, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs (doc_id, text, lang).

    Sizes are UTF-8 bytes plus 16. Dimensions are language, size and checksum of the text, which are the
    same for equal texts.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("crc"),
            F.crc32(F.encode(F.coalesce("lang", F.lit("")), "UTF-8")).alias("lang_code"),
            F.coalesce("doc_id", F.lit(-(2**63))).alias("id"),
        )
    )
    dims = ["lang_code", "size", "crc"]
    count = rows.count()
    placed = _leaves(rows, shards, dims, tolerance).withColumnRenamed("node", "shard")
    chunks = max(1, math.ceil(count / (shards * CHUNK_ROWS)))
    chunk = F.pmod(F.xxhash64("doc_id", "crc"), F.lit(chunks))
    numbered = ranked(placed, ["shard"], [F.col("id"), F.col("crc"), F.col("size")], "slot", chunk, chunks)
    return numbered.select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
