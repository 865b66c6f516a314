"""The prefix trie of conversations by range minima over sorted common prefixes.

Different conversations are sorted by their turns, and each keeps how many leading turns it shares with the
one before it (lcp). A candidate prefix, the first d turns of the conversation at some place, has as members
the places to the left and right as far as no lcp is under d. Both extents are binary-searched by
themselves in a sparse table of minima; no stack is kept. Candidates are the prefixes that a conversation
shares with the one before it, and each whole conversation; all nodes between two of them have the same
members. Sums over members and subtrees are differences of running sums.

Nothing is brought together that grows with the data: places are cut into blocks, each with a sparse table
of its own, and a table of one row a block carries searches over block borders. Turns are numbered by a
global sort, and long conversations are ranked by chunks of CHUNK turns, then by chunks of those ranks, so
neither a conversation nor a group of copies has to fit a task. The ids of a node's ends are hashed in one
stream, as SHA-256 asks, from texts of up to 64 KB.

Nulls, ties and odd rows: turns without conv_id belong to no conversation; a null turn comes first; turns of
one number are ordered by role and then text, and rows repeated in whole are as many turns; null roles and
texts are empty; a conversation whose rebuilt form has no turn ends at the root; an empty table has no node;
extra columns are ignored. Turns are compared by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmeter.llm.common import stored

#: Sorted conversations of one sparse table; turns that are ranked at once.
BLOCK, CHUNK = 1 << 16, 64
#: Turns of one running sum, and depths that are listed at once.
RUN = 4096


def numbered(df: DataFrame, order: list[Column], columns: list[str], name: str) -> DataFrame:
    """columns of df and each row's place in the order, gapless from 0, by ranges: no task sees all rows."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(rows.select(*columns, F.monotonically_increasing_id().alias("_id")))
    # One row a partition.
    part = rows.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    part = part.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    rows = rows.withColumn("_part", F.shiftright("_id", 33))
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(part, "_part").select(*columns, place.alias(name))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, at, n, k1, k2, letters): the turns of each conversation from 0, how many it has, two hashes of
    a turn's role and text, and its code points."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").alias("conv"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(role, text).alias("k1"),
        F.xxhash64(F.lit(1), text, role).alias("k2"),
        F.char_length(text).cast("long").alias("letters"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("_row")]
    rows = stored(numbered(rows, order, ["conv", "k1", "k2", "letters"], "place"))
    sizes = rows.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    return rows.join(sizes, "conv").select("conv", (F.col("place") - F.col("first")).alias("at"), "n", "k1", "k2", "letters")


def rebuilt(conversations: DataFrame, most: int = 6, family: int = 100) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv), and the turns (conv, at, k1, k2, letters) of their rebuilt form: the first
    h turns of conversation c - c % family (the remainder has the sign of c), then c's own after its first
    h; h = crc32(c) % most."""
    all_turns = stored(turns(conversations))
    # The number of turns is on each row, so the first turn alone tells it.
    convs = all_turns.where("at = 0").select(
        "conv",
        "n",
        (F.col("conv") - F.col("conv") % family).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h"),
    )
    known = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(known, "base", "left")
    convs = stored(convs.select("conv", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("kept")))
    shown = ["conv", "at", "k1", "k2", "letters"]
    heads = all_turns.where(F.col("at") < most - 1).withColumnRenamed("conv", "base")
    heads = convs.select("conv", "base", "h").join(heads, "base").where("at < h").select(*shown)
    own = all_turns.join(convs, "conv").where("at >= h").withColumn("at", F.expr("at - h + kept")).select(*shown)
    return convs.select("conv"), stored(heads.unionByName(own))


def classes(convs: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rep, n, weight) of each different conversation, rep its smallest id, and (conv, rep) of all."""
    digest = parts.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("at", "k1", "k2")).alias("d1"),
        F.bit_xor(F.xxhash64(F.lit(2), "k2", "k1", "at")).alias("d2"),
    )
    key = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "d1", "d2")]
    each = stored(convs.join(digest, "conv", "left").select("conv", *key))
    groups = each.groupBy("n", "d1", "d2").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("weight"))
    groups = stored(groups)
    return groups.select("rep", "n", "weight"), stored(each.join(groups, ["n", "d1", "d2"]).select("conv", "rep"))


def sorted_places(parts: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(rep, place) of the conversations in parts, in the order of their turns; a prefix comes first."""
    cut = F.floor(F.col("at") / chunk).cast("long")
    level = parts.groupBy("rep", cut.alias("j")).agg(F.sort_array(F.collect_list(F.struct("at", "k1", "k2"))).alias("key"))
    level = stored(level.withColumn("key", F.transform("key", lambda x: F.struct(x["k1"], x["k2"]))))
    while True:
        # Equal chunks are one row before they are sorted; a rank stands for its chunk.
        ranks = numbered(level.select("key").distinct(), [F.col("key")], ["key"], "rank")
        level = stored(level.join(ranks, "key").select("rep", "j", "rank"))
        if level.where("j > 0").isEmpty():
            return level.select("rep", F.col("rank").alias("place"))
        level = level.groupBy("rep", F.floor(F.col("j") / chunk).cast("long").alias("j")).agg(
            F.sort_array(F.collect_list(F.struct("j", "rank"))).alias("key")
        )
        level = stored(level.withColumn("key", F.col("key.rank")))


def sums_before(parts: DataFrame, run: int = RUN) -> DataFrame:
    """parts with before: the code points of the earlier turns of the same rep."""
    cut = parts.withColumn("_run", F.floor(F.col("at") / run).cast("long"))
    runs = cut.groupBy("rep", "_run").agg(F.sum("letters").alias("_sum"))
    earlier = Window.partitionBy("rep").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("rep", "_run", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("rep", "_run").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_in", F.coalesce(F.sum("letters").over(inside), F.lit(0)))
    joined = cut.join(runs, ["rep", "_run"])
    return joined.withColumn("before", F.col("_base") + F.col("_in")).drop("_run", "_sum", "_base", "_in")


def minima(values: np.ndarray) -> list[np.ndarray]:
    """The sparse table: at level k the least of the 2**k values from each place on."""
    table, width = [values], 1
    while 2 * width <= len(values):
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
        width *= 2
    return table


def least(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value from place first to place last, both inclusive."""
    level = np.frexp((last - first + 1).astype(float))[1] - 1
    out = np.empty(len(first), table[0].dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][first[at]], table[k][last[at] - (1 << int(k)) + 1])
    return out


def reach(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of the places that share depth turns with place at, by two binary searches in the
    minima of the lcps; the lcp at place 0 leads out of the block and is not read."""
    n, left, right = len(table[0]), at.copy(), at.copy()
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        rows = np.flatnonzero(left >= step)
        rows = rows[table[k][left[rows] - step + 1] >= depth[rows]]
        left[rows] -= step
        rows = np.flatnonzero(right + step < n)
        rows = rows[table[k][right[rows] + 1] >= depth[rows]]
        right[rows] += step
    return left, right


def beyond(table: list[np.ndarray], block: int, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest blocks before and after that hold an lcp under depth (-1: none), by the same searches in
    the minima of blocks."""
    n = len(table[0])
    left, right = (np.full(len(depth), block) for _ in range(2))
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        rows = np.flatnonzero(left >= step)
        rows = rows[table[k][left[rows] - step] >= depth[rows]]
        left[rows] -= step
        rows = np.flatnonzero(right + step < n)
        rows = rows[table[k][right[rows] + 1] >= depth[rows]]
        right[rows] += step
    return left - 1, np.where(right + 1 < n, right + 1, -1)


_SUMS = ["weight", "leaf", "paths", "fresh"]
_CLASS = "place long, lcp long, next long, n long, total long, rep long, weight long, leaf long, paths long, fresh long"
_FOUND = (
    "place long, lcp long, next long, n long, total long, weight long, leaf long, paths long, fresh long, "
    "weight_to long, leaf_to long, paths_to long, fresh_to long, least_from long, least_to long, "
    "kind int, depth long, first long, last long, low long, left_block long, right_block long"
)


def searched(rows: DataFrame, block: int) -> DataFrame:
    """For each class and both of its candidates: running sums, and the extents (first, last) and smallest
    id (low) of the candidate's members. Rows have the columns of _CLASS."""
    rows = stored(rows.withColumn("block", F.floor(F.col("place") / block).cast("long")))
    heads = rows.groupBy("block").agg(
        F.min("lcp").alias("lcp"), F.min("rep").alias("rep"), *[F.sum(c).alias(c) for c in _SUMS]
    )
    # One row for each `block` conversations.
    heads = heads.orderBy("block").toPandas()
    base = {c: np.concatenate([[0], np.cumsum(heads[c].to_numpy(np.int64))]) for c in _SUMS}
    tops, ids = minima(heads["lcp"].to_numpy(np.int64)), minima(heads["rep"].to_numpy(np.int64))
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("place")
        x = {c: part[c].to_numpy() for c in part.column_names}
        own, m, begin = int(x["block"][0]), len(x["place"]), x["place"][0]
        table, reps = minima(x["lcp"]), minima(x["rep"])
        fixed = {c: x[c] for c in ("place", "lcp", "next", "n", "total", *_SUMS)}
        fixed |= {f"{c}_to": base[c][own] + np.cumsum(x[c]) for c in _SUMS}
        fixed["least_from"] = np.minimum.accumulate(x["rep"][::-1])[::-1]
        fixed["least_to"] = np.minimum.accumulate(x["rep"])
        out = []
        for kind, depth in ((1, x["lcp"]), (2, x["n"])):
            at = np.flatnonzero(depth >= 0)
            depth = depth[at]
            left, right = reach(table, at, depth)
            before, after = beyond(tops, own, depth)
            open_left = (left == 0) & (x["lcp"][0] >= depth)
            open_right = (right == m - 1) & (x["next"][-1] >= depth)
            low = least(reps, left, right)
            whole = ~(open_left | open_right)
            rows = {c: v[at] for c, v in fixed.items()}
            rows |= {"kind": np.full(len(at), kind, np.int32), "depth": depth}
            rows |= {"first": left + begin, "last": right + begin}
            arrays = {c: pa.array(v) for c, v in rows.items()}
            arrays["low"] = pa.array(low, mask=~whole)
            arrays["left_block"] = pa.array(before, mask=~open_left)
            arrays["right_block"] = pa.array(after, mask=~open_right)
            out.append(pa.table([arrays[c] for c in names], names=names))
        return pa.concat_tables(out)

    found = stored(rows.groupBy("block").applyInArrow(run, _FOUND))
    if len(heads) == 1:
        return found.drop("left_block", "right_block")
    sides = [("left_block", "left"), ("right_block", "right")]
    asked = [
        found.where(f"{c} is not null").select(F.col(c).alias("block"), F.lit(side).alias("side"), "depth")
        for c, side in sides
    ]
    asked = stored(asked[0].unionByName(asked[1]).distinct())
    answer = "block long, side string, depth long, edge long"

    def edges(held: pa.Table, ask: pa.Table) -> pa.Table:
        if not ask.num_rows or not held.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64())], names=["block", "side", "depth", "edge"])
        held = held.sort_by("place")
        place, lcp, depth = held["place"].to_numpy(), held["lcp"].to_numpy(), ask["depth"].to_numpy()
        to_end = np.minimum.accumulate(lcp[::-1])[::-1]
        to_here = np.minimum.accumulate(lcp)
        # The last place under depth begins the members on the left; the first one ends them on the right.
        left = np.searchsorted(to_end, depth, "left") - 1
        right = np.searchsorted(-to_here, -depth, "right") - 1
        is_left = np.array([s == "left" for s in ask["side"].to_pylist()])
        edge = np.where(is_left, place[np.maximum(left, 0)], place[0] + right)
        return pa.table([ask["block"], ask["side"], ask["depth"], pa.array(edge)], names=["block", "side", "depth", "edge"])

    held = rows.select("block", "place", "lcp")
    known = stored(held.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(edges, answer))
    for (c, side), name in zip(sides, ("first", "last"), strict=True):
        edge = known.where(F.col("side") == side).select(F.col("block").alias(c), "depth", F.col("edge").alias(f"{name}_edge"))
        found = found.join(edge, [c, "depth"], "left")
    end = int(heads["weight"].size and rows.agg(F.max("place")).first()[0])
    found = found.withColumn("first", F.coalesce("first_edge", "first"))
    found = found.withColumn("last", F.when(F.col("right_block") == -1, end).otherwise(F.coalesce("last_edge", "last")))
    # The smallest id over block borders: the end of one block, whole blocks, the begin of another.
    begins = found.where("kind = 2").select(F.col("place").alias("first"), F.col("least_from").alias("_begin"))
    stops = found.where("kind = 2").select(F.col("place").alias("last"), F.col("least_to").alias("_stop"))
    found = found.join(begins, "first").join(stops, "last")
    kept = [c for c in names if c not in ("low", "left_block", "right_block")]

    def lows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = {c: batch.column(batch.schema.get_field_index(c)) for c in ("low", "first", "last", "_begin", "_stop")}
            low = np.minimum(x["_begin"].to_numpy(), x["_stop"].to_numpy())
            a, b = x["first"].to_numpy() // block + 1, x["last"].to_numpy() // block - 1
            between = np.flatnonzero(a <= b)
            low[between] = np.minimum(low[between], least(ids, a[between], b[between]))
            own = x["low"].is_valid().to_numpy(zero_copy_only=False)
            low[own] = x["low"].drop_null().to_numpy()
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array(low)], [*kept, "low"])

    kind = ", ".join(f"{c} {'int' if c == 'kind' else 'long'}" for c in [*kept, "low"])
    return stored(found.select(*kept, "low", "_begin", "_stop").mapInArrow(lows, kind))


def ends_hashes(members: DataFrame) -> DataFrame:
    """(place, ends): the SHA-256 of the ids (conv) of each place, ascending and comma-joined."""
    order = [F.col("place"), F.col("conv")]
    rows = members.repartitionByRange(*order).sortWithinPartitions(*order)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, conv = (c.to_numpy() for c in batch.columns)
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (np.arange(1, len(place)) % RUN == 0)
            begin = np.flatnonzero(new)
            written = conv.astype(str).tolist()
            joined = [",".join(written[a:b]) for a, b in zip(begin, [*begin[1:], len(place)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(place[begin]), pa.array(conv[begin]), pa.array(joined, pa.string())], ["place", "conv", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for place, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if place != now:
                    if state:
                        done.append((now, state.hexdigest()))
                    now, state = place, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["place", "ends"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["place", "ends"])

    rows = stored(rows.select("place", "conv").mapInArrow(texts, "place long, conv long, ids string"))
    return rows.repartition("place").sortWithinPartitions("place", "conv").mapInArrow(hashes, "place long, ends string")


def prefix_trie(conversations: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each
    node of the trie of the rebuilt conversations."""
    convs, rebuilt_turns = rebuilt(conversations)
    groups, members = classes(convs, rebuilt_turns)
    parts = rebuilt_turns.withColumnRenamed("conv", "rep").join(groups.select("rep"), "rep", "left_semi")
    places = sorted_places(parts, chunk)
    # The one conversation without turns, if any, is a prefix of all others.
    turnless = groups.where("n = 0").select("rep", F.lit(0).cast("long").alias("place"))
    shift = 0 if turnless.isEmpty() else 1
    places = stored(places.withColumn("place", F.col("place") + shift).unionByName(turnless))
    parts = stored(sums_before(parts).join(places, "rep").select("place", "at", "k1", "k2", "letters", "before"))
    other = parts.select((F.col("place") + 1).alias("place"), "at", F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    apart = parts.join(other, ["place", "at"], "left").where("p1 is null or p1 <> k1 or p2 <> k2")
    shared = apart.groupBy("place").agg(F.min("at").alias("lcp"), F.min_by("before", "at").alias("common"))
    totals = parts.groupBy("place").agg(F.sum("letters").alias("total"))
    first = F.col("place") == 0
    rows = groups.join(places, "rep").join(totals, "place", "left").join(shared, "place", "left").select(
        "place",
        F.when(first, -1).otherwise(F.col("lcp")).alias("lcp"),
        "n",
        "rep",
        "weight",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.when(first, 0).otherwise(F.col("common")).alias("common"),
    )
    rows = stored(rows)
    if rows.isEmpty():
        return conversations.sparkSession.createDataFrame([], _NODE)
    after = rows.where("place > 0").select((F.col("place") - 1).alias("place"), F.col("lcp").alias("next"))
    rows = rows.join(after, "place", "left").withColumn("next", F.coalesce("next", F.lit(-1)))
    rows = rows.withColumns(
        {
            "leaf": F.when(F.col("next") < F.col("n"), 1).otherwise(0).cast("long"),
            "paths": F.col("weight") * F.col("total"),
            "fresh": F.col("total") - F.col("common"),
        }
    )
    found = searched(rows.select(*[F.col(c.split()[0]).cast("long") for c in _CLASS.split(", ")]), block)
    nodes = found.groupBy("first", "last", "depth").agg(F.count_if(F.col("kind") == 1).alias("cuts"), F.min("low").alias("low"))
    own = found.where("kind = 2")
    begins = own.select(
        F.col("place").alias("first"),
        F.col("lcp").alias("lcp"),
        F.col("n").alias("own_n"),
        F.col("total").alias("own_total"),
        *[(F.col(f"{c}_to") - F.col(c)).alias(f"{c}_0") for c in ("weight", "leaf", "paths")],
        F.col("fresh_to").alias("fresh_0"),
    )
    stops = own.select(F.col("place").alias("last"), "next", *[f"{c}_to" for c in _SUMS])
    nodes = nodes.join(begins, "first").join(stops, "last")
    nodes = nodes.withColumn("above", F.greatest("lcp", "next"))
    nodes = nodes.withColumn("cut", F.when(F.col("lcp") >= F.col("next"), F.col("first")).otherwise(F.col("last") + 1))
    above = found.where("kind = 1").select(F.col("place").alias("cut"), F.col("low").alias("above_low"))
    nodes = stored(nodes.join(above, "cut", "left"))
    # All depths from the node above (not included) to this one have the same members.
    runs = F.sequence(F.floor((F.col("above") + 1) / RUN), F.floor(F.col("depth") / RUN))
    nodes = nodes.withColumn("_run", F.explode(runs))
    depths = F.sequence(F.greatest(F.col("above") + 1, F.col("_run") * RUN), F.least("depth", F.col("_run") * RUN + RUN - 1))
    nodes = nodes.withColumn("e", F.explode(depths))
    before = parts.select(F.col("place").alias("first"), (F.col("at") + 1).alias("e"), "before")
    nodes = nodes.join(before, ["first", "e"], "left").withColumn("before", F.coalesce("before", F.lit(0)))
    ends = ends_hashes(members.join(places, "rep").select("place", "conv")).withColumnRenamed("place", "first")
    nodes = nodes.join(ends, "first")
    n_convs = F.col("weight_to") - F.col("weight_0")
    # Members weighted by their letters from this node on, less each node's letters once.
    paths = F.col("paths_to") - F.col("paths_0") - n_convs * F.col("before")
    once = F.col("fresh_to") - F.col("fresh_0") + F.col("own_total") - F.col("before")
    whole = F.col("e") == F.col("depth")
    children = F.col("cuts") + F.when(F.col("own_n") > F.col("depth"), 1).otherwise(0)
    return nodes.select(
        F.col("low").alias("conv_id"),
        F.col("e").alias("depth"),
        F.when(F.col("e") > F.col("above") + 1, F.col("low")).when(F.col("e") > 0, F.col("above_low")).alias("parent_conv_id"),
        n_convs.alias("n_convs"),
        F.when(whole, children).otherwise(1).cast("long").alias("n_children"),
        (F.col("leaf_to") - F.col("leaf_0")).alias("n_leaves"),
        (paths - once).alias("saved_tokens"),
        F.when(F.col("e") == F.col("own_n"), F.col("ends")).otherwise(F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
