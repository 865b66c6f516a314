"""Near-duplicate documents by SetSketch registers.

A document's shingles drop points of a Poisson process on its registers; a register keeps the earliest
time, truncated to a power of a base. Registers of a union are the larger of two registers, and equal
registers are about as frequent as shared shingles. Bands of registers give candidates, a likelihood
over all registers estimates the similarity, and full shingle sets decide.

Nulls, ties and odd rows: a null or empty text has no shingles and links with nothing; a row without id
is returned alone with a null component; repeated rows of an id share its links and are all returned;
columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmeter.llm.common import components, stored
from trailmeter.llm.shingles import mix, pieces, shingle_sets

#: Rows a band, bands; a pair at 0.8 shares no band once in more than a million times.
ROWS, BANDS = 6, 48
#: Registers are truncated to powers of this base; one byte holds them.
BASE, SHIFT = 1.1, 40
#: Pairs below this estimate are five standard errors under 0.8.
LEAST_ESTIMATE = 0.64
#: Pairs of two components that are tested before all others of them.
PROBES = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)


def registers(row: np.ndarray, value: np.ndarray, rows: int, m: int) -> np.ndarray:
    """One byte for each of m registers of each row, from (row, hash) of distinct elements.

    Each element's points come in order of time, so an element is done once it is later than all
    registers of its row.
    """
    times = np.full(rows * m, np.inf)
    at = np.zeros(len(row))
    state = value.copy()
    while len(row):
        # The fewer elements are left, the more points of each are drawn at once.
        points = min(64, max(1, 16_384 // len(row)))
        drawn = mix(state[:, None] + _STEP * np.arange(1, points + 1, dtype=np.uint64))
        when = at[:, None] - np.cumsum(np.log1p((drawn >> np.uint64(11)) * -(2.0**-53)), axis=1) / m
        slot = ((drawn & np.uint64(0x7FF)) * np.uint64(m) >> np.uint64(11)).astype(np.int64)
        np.minimum.at(times, (slot + (row * m)[:, None]).ravel(), when.ravel())
        state, at = state + _STEP * np.full(1, points, np.uint64), when[:, -1]
        left, place = np.unique(row, return_inverse=True)
        open_ = at < times.reshape(rows, m)[left].max(axis=1)[place]
        row, at, state = row[open_], at[open_], state[open_]
    with np.errstate(divide="ignore"):
        level = np.floor(SHIFT - np.log(times) / np.log(BASE))
    return np.clip(level, 0, 255).astype(np.uint8).reshape(rows, m)


def likely_similarity(u: np.ndarray, v: np.ndarray, nu: np.ndarray, nv: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs, from registers u and v and set sizes nu and nv."""
    above, below = (u > v).sum(axis=1), (u < v).sum(axis=1)
    same = u.shape[1] - above - below
    fu, fv = nu / (nu + nv), nv / (nu + nv)
    most = np.minimum(fu / fv, fv / fu)

    def part(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    best, found = np.full(len(u), -np.inf), np.zeros(len(u))
    for step in range(101):
        j = most * step / 100
        more, less = part(fu - fv * j), part(fv - fu * j)
        with np.errstate(divide="ignore", invalid="ignore"):
            fit = sum(
                np.where(k > 0, k * np.log(np.maximum(p, 1e-300)), 0.0)
                for k, p in ((above, more), (below, less), (same, 1 - more - less))
            )
        better = fit > best
        best, found = np.where(better, fit, best), np.where(better, j, found)
    return found


def sketches(docs: DataFrame, width: int, m: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, sketch): the set's size, a 128-bit digest of it and its registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in pieces(batch.column(1)):
                row, value = shingle_sets(data, offsets, width)
                rows = end - begin
                size = np.bincount(row, minlength=rows)
                digest = np.zeros((2, rows), np.uint64)
                if len(row):
                    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                    digest[0, row[first]] = np.add.reduceat(mix(value + _STEP), first)
                    digest[1, row[first]] = np.add.reduceat(mix(value ^ _STEP), first)
                got = registers(row, value, rows, m)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, rows),
                        pa.array(size.astype(np.int64)),
                        pa.array(digest[0].view(np.int64)),
                        pa.array(digest[1].view(np.int64)),
                        pa.array([r.tobytes() for r in got], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "sketch"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, sketch binary"
    )


def estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose likely similarity is not far below the limit."""
    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, na, sa, nb, sb = batch.columns
            u, v = (np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(len(s), -1) for s in (sa, sb))
            found = likely_similarity(u, v, na.to_numpy().astype(float), nb.to_numpy().astype(float))
            keep = pa.array(found >= LEAST_ESTIMATE)
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    # A set under 0.8 times the size of the other can't reach the limit.
    fits = "5 * least(na, nb) >= 4 * greatest(na, nb)"
    joined = pairs.join(left, "a").join(right, "b").where(fits)
    return joined.select("a", "b", "na", "sa", "nb", "sb").mapInArrow(run, "a long, b long")


def full_sets(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, set) of the ids (node): the sorted shingle hashes as bytes, from whole texts."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in pieces(batch.column(1)):
                row, value = shingle_sets(data, offsets, width)
                cut = np.searchsorted(row, np.arange(end - begin + 1))
                whole = [value[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array(whole, pa.binary())], ["node", "set"]
                )

    wanted = ids.select(F.col("node").alias("doc_id")).distinct()
    # As many ids as documents with partners: they grow with the data, so they are never broadcast.
    texts = docs.select("doc_id", "text").join(wanted.hint("merge"), "doc_id")
    return texts.mapInArrow(sets, "node long, set binary").dropDuplicates(["node"])


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked, shared, na, rest) of pairs: whether the full sets share at least percent of their
    union, how many they share, the size of a and what a has beside b."""

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, shares, sizes, rest = [], [], [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(v, u), len(v) - 1)
                there = v[at] == u
                shared = int(there.sum())
                linked.append(100 * shared >= percent * (len(u) + len(v) - shared))
                shares.append(shared)
                sizes.append(len(u))
                rest.append(u[~there].view(np.int64))
            counts = [pa.array(x, pa.int64()) for x in (shares, sizes)]
            own = pa.array(rest, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(linked, pa.bool_()), *counts, own],
                ["a", "b", "linked", "shared", "na", "rest"],
            )

    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    joined = joined.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    joined = joined.select("a", "b", "sa", "sb")
    return joined.mapInArrow(same, "a long, b long, linked boolean, shared long, na long, rest array<long>")


def _size_bin(size: Column) -> Column:
    """Sizes up to 2 % apart share a bin or lie in neighbouring ones; bins follow sizes."""
    return F.floor(F.log(size.cast("double")) / math.log(1.02)).cast("long")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text).

    Equal sets become one node first, so copies cost nothing later. In each bucket of a band all nodes
    are compared with the one of the smallest id, p. Say that x isn't linked with p. What x and y share
    inside p is then less than percent / (100 + percent) of the sizes of x and p, so x and y can only be
    linked if they share a shingle that p lacks, or if y is so much smaller than p that their parts of p
    alone could do. The first pairs follow from an index of the shingles beside p, the second from the
    counts, so groups that hang together, or that share one text, make no pairs.
    """
    base = stored(sketches(docs, width, rows * bands))
    some = base.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("node"))
    member = stored(some.select("doc_id", "d1", "d2", "n_shingles").join(classes, ["d1", "d2", "n_shingles"]))
    own = member.where("doc_id = node").select("node", "d1", "d2", "n_shingles").distinct()
    heads = some.select(F.col("doc_id").alias("node"), "d1", "d2", "n_shingles", "sketch")
    nodes = stored(
        heads.join(own, ["node", "d1", "d2", "n_shingles"], "left_semi")
        .dropDuplicates(["node"])
        .select("node", "n_shingles", "sketch")
    )
    cells = [
        F.xxhash64(F.expr(f"substring(sketch, {i * rows + 1}, {rows})"), F.lit(i)) for i in range(bands)
    ]
    spread = nodes.select("node", F.explode(F.array(*cells)).alias("bucket"))
    heads = spread.groupBy("bucket").agg(F.min("node").alias("b"), F.count("node").alias("n"))
    star = spread.join(heads.where("n > 1").select("bucket", "b"), "bucket")
    pairs = stored(star.where("node <> b").select(F.col("node").alias("a"), "b").distinct())
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    sets = stored(full_sets(ends, docs, width))
    tested = stored(compared(pairs, sets, percent))
    links = tested.where("linked").select("a", "b")
    label = components(links)
    mark = label.select(F.col("node").alias("a"), F.col("component").alias("c"))
    left = tested.join(mark, "a", "left").withColumn("c", F.coalesce("c", "a"))
    index = stored(left.select("a", "b", "c", "linked", F.explode("rest").alias("s")))
    busy = index.groupBy("b", "s").agg(
        F.min("c").alias("x"), F.max("c").alias("y"), F.min("linked").alias("all"), F.count("c").alias("f")
    )
    busy = index.join(busy.where("x < y and not all").select("b", "s", "f"), ["b", "s"])
    # Of the q shingles of a that others have as well, a partner shares need at least; so it shares one of
    # the rarest q - need + 1.
    small = left.groupBy("b").agg(F.min("na").alias("least"))
    rare = Window.partitionBy("b", "a")
    need = f"ceil({percent} * (na + least) / {100 + percent}) - shared"
    sized = left.join(small, "b").select("b", "a", "na", "shared", F.expr(need).alias("need"))
    busy = busy.withColumn("q", F.count("s").over(rare))
    busy = busy.withColumn("i", F.row_number().over(rare.orderBy("f", "s")))
    busy = stored(
        busy.join(sized, ["b", "a"]).where("i <= q - greatest(need, 1) + 1").drop("f", "need")
    )
    parts = ["a", "c", "na", "shared", "q", "i"]
    other = busy.select("b", "s", *[F.col(x).alias(f"{x}2") for x in parts])
    met = busy.where("not linked").join(other, ["b", "s"]).where(
        "c <> c2 and "
        f"{100 + percent} * (least(shared, shared2) + least(q, q2)) >= {percent} * (na + na2)"
    )
    # Both are in one order, so up to the last shingle they meet in they share just those they meet in, and
    # behind it at most what is left of the shorter list.
    kept = [x for x in met.columns if x not in ("s", "linked", "i", "i2")]
    met = met.groupBy(*kept).agg(F.count("s").alias("hits"), F.max("i").alias("i"), F.max("i2").alias("i2"))
    behind = "hits + least(q - i, q2 - i2)"
    met = met.where(f"{100 + percent} * (least(shared, shared2) + {behind}) >= {percent} * (na + na2)")
    across = met.select("a", "a2", "c", "c2", "hits")
    mine = left.where("not linked").join(small, "b")
    mine = mine.where(f"{100 + percent} * shared >= {percent} * (na + least)")
    # What a2 has in p bounds the size of a partner from above, so partners are looked up by size.
    most = f"least(({100 + percent} * shared - {percent} * na) / {percent}, 100 * na / {percent})"
    mine = mine.withColumn("lo", F.expr(f"{percent} * na / 100")).withColumn("hi", F.expr(most))
    sizes = F.sequence(_size_bin(F.col("lo")), _size_bin(F.col("hi")))
    mine = mine.where("lo <= hi").withColumn("bin", F.explode(sizes))
    mine = mine.select("b", "bin", F.col("a").alias("a2"), F.col("c").alias("c2"), F.col("na").alias("n2"),
                       F.col("shared").alias("s2"))
    inside = left.withColumn("bin", _size_bin(F.col("na"))).join(mine, ["b", "bin"]).where(
        f"a <> a2 and c <> c2 and {100 + percent} * least(shared, s2) >= {percent} * (na + n2)"
    )
    across = across.union(inside.select("a", "a2", "c", "c2", F.lit(0).cast("long")))
    ends = [F.least("a", "a2").alias("a"), F.greatest("a", "a2").alias("b")]
    sides = [F.least("c", "c2").alias("c"), F.greatest("c", "c2").alias("c2")]
    across = stored(across.groupBy(*ends, *sides).agg(F.max("hits").alias("hits")))

    def linked(some: DataFrame) -> DataFrame:
        more = stored(estimated(some.select("a", "b"), nodes))
        return stored(compared(more, sets, percent).where("linked").select("a", "b"))

    # Two components that hang together mostly link where they meet most often, which makes their other
    # pairs needless; only those that still lie apart are tested.
    if not across.isEmpty():
        order = Window.partitionBy("c", "c2").orderBy(F.desc("hits"), "a", "b")
        across = across.withColumn("_rank", F.row_number().over(order))
        links = stored(links.union(linked(across.where(f"_rank <= {PROBES}"))))
        label = components(links)
        for end, mark in (("c", "d"), ("c2", "d2")):
            own = label.select(F.col("node").alias(end), F.col("component").alias(mark))
            across = across.join(own, end, "left").withColumn(mark, F.coalesce(mark, end))
        more = linked(across.where(f"_rank > {PROBES} and d <> d2"))
        if not more.isEmpty():
            label = components(stored(links.union(more)))
    # Ids whose repeated rows have different texts tie their classes together as well.
    final = member.select("doc_id", "n_shingles", "node").join(label, "node", "left")
    final = final.select("doc_id", F.coalesce("component", "node").alias("component_id"))
    final = final.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = base.select("doc_id", "n_shingles").join(final, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )
