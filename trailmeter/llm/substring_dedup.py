"""Substring dedup by hashing: lines, paragraphs, sentences, and runs of words anywhere.

Sentences of each line of at least least_words words are units. With run_words, as the query asks, so are
- lines of LINE_WORDS words or more, and paragraphs of several lines;
- the shortest runs of whole sentences of least_words words or more that begin or end with a shorter one, so
  every repeated run of whole sentences (a list, a verse) is found, whatever its lines hold;
- all runs of run_words words, wherever they begin and end. The least hash among a run's shingles is its
  anchor, and neighbouring runs with one anchor are a segment, which is hashed as a whole. A segment that
  lies elsewhere as it is says the same of its runs. Only where an anchor has several segments, as at the
  ends of a passage, are the runs of one segment of each kind hashed themselves.
A first pass over the texts gives short hashes of units and segments; a second one gives digests of those
that the first found in several places.
A unit is normalised (lower case, single spaces), its 128-bit digest is grouped over all documents, the
occurrence of the smallest (doc_id, place) stays and the others are removed, save those that overlap it;
offsets are those of the original text. With run_words, removed units that touch are one span.

A word of a run is what white space parts; in scripts without spaces a letter, and in LONG letters or more
without a space a piece that ends where a hash of the last four letters says so.

Nulls, ties and odd rows: a null or empty text has no units; a null id ranks after all others; rows
repeated with one id are one document, so their equal units stay or go together (with run_words, texts
without id are told apart by a digest); extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmeter.llm.common import collected, removed, stored
from trailmeter.llm.shingles import mix

LEAST_WORDS, LINE_WORDS = 8, 3
#: Words of a run that is found wherever it lies, and letters without a space that are cut by their hash.
RUN_WORDS, LONG = 50, 64
#: Runs of one segment at most, for texts that repeat themselves.
SEGMENT = 64
#: Letters that are hashed at once; a longer document is one piece of its own.
PIECE = 1 << 18
_UNIT = re.compile(r"[^\n.!?]+[.!?]*")
_TOP = 0x20000
_LOWER = np.array([ord(c) if len(c := chr(i).lower()) == 1 else i for i in range(_TOP)], np.uint32)
_SPACE = np.array([chr(i).isspace() for i in range(_TOP)])
#: Thai, Lao, Burmese, Khmer, kana and Han letters; letters from _TOP on are Han, too.
_UNSPACED = np.zeros(_TOP, bool)
for _a, _b in ((0xE00, 0xF00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x2E80, 0xA4D0), (0xF900, 0xFB00)):
    _UNSPACED[_a:_b] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASES = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_KIND = "kind int, at int, size int, start int, end int, word int, last int, d1 long, d2 long"


def units(docs: DataFrame, least_words: int) -> DataFrame:
    """(doc_id, start, end, n_words, d1, d2) of the units of each text, in code points, end exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends, sizes, digests = [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                for unit in _UNIT.finditer(value.as_py() or ""):
                    words = unit.group().lower().split()
                    if len(words) >= least_words:
                        rows.append(i)
                        starts.append(unit.start())
                        ends.append(unit.end())
                        sizes.append(len(words))
                        digests.append(blake2b(" ".join(words).encode(errors="replace"), digest_size=16).digest())
            halves = [[int.from_bytes(d[k : k + 8], "little", signed=True) for d in digests] for k in (0, 8)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    *[pa.array(x, pa.int64()) for x in (starts, ends, sizes, *halves)],
                ],
                ["doc_id", "start", "end", "n_words", "d1", "d2"],
            )

    kind = "doc_id long, start long, end long, n_words long, d1 long, d2 long"
    return docs.select("doc_id", "text").mapInArrow(run, kind)


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n powers or more of an odd base and of its inverse; those of a usual piece are kept."""
    if base in _powers and len(_powers[base][0]) >= n:
        return _powers[base]
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    made = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    if n <= 2 * PIECE:
        _powers[base] = made
    return made


def _sums(values: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[first:last], each multiplied by a power of base for its place."""
    up, down = _power(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[last] - total[first]) * down[first])


def words(
    texts: list[str], bases: tuple[int, ...] = _BASES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(row, start, end, a hash for each base) of the words of texts; places are code points of the joined texts,
    each of which is followed by one line end."""
    letters = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    low = np.minimum(letters, _TOP - 1)
    space, single = _SPACE[low], _UNSPACED[low] | (letters >= _TOP)
    letters = np.where(letters < _TOP, _LOWER[low], letters)
    edge = np.ones(len(letters) + 1, bool)
    edge[1:-1] = space[1:] | space[:-1] | single[1:] | single[:-1]
    code = mix(letters.astype(np.uint64) + np.uint64(1))
    size = np.diff(np.flatnonzero(edge))
    if (size >= LONG).any():
        four = code.copy()
        for k in range(1, 4):
            four[k:] += code[:-k] * np.uint64(2 * k + 1)
        edge[1:] |= np.repeat(size >= LONG, size) & (mix(four) & np.uint64(7) == 0)
    edges = np.flatnonzero(edge)
    start, end = edges[:-1], edges[1:]
    real = ~space[start]
    start, end = start[real], end[real]
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes = [_sums(mix(code + np.uint64(b)), start, end, b) for b in bases]
    return np.searchsorted(ends, start, "right"), start, end, hashes


def _extreme(x: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """The least or largest of each n values in a row."""
    out, width = x, 1
    while width < n:
        step = min(width, n - width)
        out, width = pick(out[:-step], out[step:]), width + step
    return out


def _anchors(row: np.ndarray, value: np.ndarray, run_words: int) -> tuple[np.ndarray, ...]:
    """(first words of the runs inside one text, their anchors, places of all anchors, these anchors)."""
    width = run_words // 2 + 1
    count = run_words - width + 1
    if len(row) < run_words:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none.astype(np.uint64)
    at = np.arange(len(row) - width + 1)
    shingle = _sums(value, at, at + width, _BASES[0])
    least = _extreme(shingle, count, np.minimum)
    whole = row[: len(least)] == row[run_words - 1 :]
    # A shingle is an anchor where it is the least of some run that holds it.
    pad = np.zeros(count - 1, np.uint64)
    near = _extreme(np.concatenate([pad, np.where(whole, least, np.uint64(0)), pad]), count, np.maximum)
    chosen = near == shingle
    return np.flatnonzero(whole), least[whole], np.flatnonzero(chosen), shingle[chosen]


def _sentences(
    text: str, least_words: int, wanted: set[int] | None = None
) -> list[tuple[int, int, int, int, bytes]]:
    """(place in words, words, start, end, digest) of sentences, of runs of them at a shorter one, of lines
    and of paragraphs of several lines; with wanted only of those at these places."""
    starts, ends, joined, place = [], [], [], [0]
    lines, blocks, before, n = [0], [0], 0, 0
    low = text.lower()
    # Lowered as a whole where no letter becomes two and none hangs on its neighbours, as a final sigma does.
    whole = len(low) == len(text) and "Σ" not in text
    for unit in _UNIT.finditer(low if whole else text):
        if found := (unit.group() if whole else unit.group().lower()).split():
            start, end = unit.span()
            if breaks := text.count("\n", before, start):
                lines.append(n)
                # A line without a word parts paragraphs.
                if breaks > 1:
                    blocks.append(n)
            starts.append(start)
            ends.append(end)
            joined.append(" ".join(found))
            place.append(place[-1] + len(found))
            before = end
            n += 1
    lines.append(n)
    blocks.append(n)
    pairs = list(zip(lines, lines[1:], strict=False))
    spans = {(a, b - 1) for a, b in pairs if place[b] - place[a] >= LINE_WORDS}
    spans |= {(a, b - 1) for a, b in set(zip(blocks, blocks[1:], strict=False)).difference(pairs) if a < b}
    for k in range(n):
        if place[k + 1] - place[k] >= least_words:
            spans.add((k, k))
            continue
        end = k
        while end + 1 < n and place[end + 1] - place[k] < least_words:
            end += 1
        if place[end + 1] - place[k] >= least_words:
            spans.add((k, end))
        first = k
        while first and place[k + 1] - place[first] < least_words:
            first -= 1
        if place[k + 1] - place[first] >= least_words:
            spans.add((first, k))
    out = []
    for a, b in spans:
        if wanted is None or place[a] in wanted:
            whole = joined[a] if a == b else " ".join(joined[a : b + 1])
            digest = blake2b(whole.encode(errors="replace"), digest_size=16).digest()
            out.append((place[a], place[b + 1] - place[a], starts[a], ends[b], digest))
    return out


def _unit_marks(texts: list[str], least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in words, hash) of the units that _sentences finds, by numpy over the letters of all texts.
    Equal units have equal hashes; the second pass tells apart what only agrees here, as the two small sigmas do."""
    low = [t.lower() for t in texts]
    letters = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    letters = np.where(letters == ord("ς"), np.uint32(ord("σ")), letters)
    breaks = letters == ord("\n")
    stop = (letters == ord(".")) | (letters == ord("!")) | (letters == ord("?"))
    parts = breaks | stop
    begin = ~parts
    begin[1:] &= parts[:-1]
    # Stops belong to the unit before them, if no line end lies in between.
    place = np.arange(len(letters), dtype=np.int32)
    inside = np.maximum.accumulate(np.where(parts, -1, place)) > np.maximum.accumulate(np.where(breaks, place, -1))
    inside &= ~_SPACE[np.minimum(letters, _TOP - 1)]
    start, end = inside.copy(), inside.copy()
    start[1:] &= begin[1:] | ~inside[:-1]
    end[:-1] &= begin[1:] | ~inside[1:]
    first, last = np.flatnonzero(start), np.flatnonzero(end) + 1
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none
    value = _sums(mix(letters.astype(np.uint64) + np.uint64(1)), first, last, _BASES[0])
    unit = np.cumsum(begin, dtype=np.int32)[first]
    head = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    n, word = len(head), np.r_[head, len(first)]
    row = np.searchsorted(np.cumsum([len(t) + 1 for t in low]), first[head], "right")
    line = np.cumsum(breaks, dtype=np.int32)[first[head]]
    gap = np.diff(line)
    top = np.r_[0, np.flatnonzero(gap > 0) + 1, n]
    lines = np.stack([top[:-1], top[1:] - 1])
    lines = lines[:, word[lines[1] + 1] - word[lines[0]] >= LINE_WORDS]
    top = np.r_[0, np.flatnonzero((gap > 1) | (row[1:] != row[:-1])) + 1, n]
    blocks = np.stack([top[:-1], top[1:] - 1])
    blocks = blocks[:, line[blocks[0]] != line[blocks[1]]]
    whole = np.diff(word) >= least_words
    full, short = np.flatnonzero(whole), np.flatnonzero(~whole)
    ahead = np.stack([short, np.searchsorted(word, word[short] + least_words, "left") - 1])
    ahead = ahead[:, ahead[1] < n]
    behind = np.stack([np.searchsorted(word, word[short + 1] - least_words, "right") - 1, short])
    behind = behind[:, behind[0] >= 0]
    runs = np.concatenate([ahead, behind], axis=1)
    runs = runs[:, row[runs[0]] == row[runs[1]]]
    spans = np.concatenate([lines, blocks, np.stack([full, full]), runs], axis=1)
    a, b = np.divmod(np.unique(spans[0] * n + spans[1]), n)
    own = row[a]
    h = _sums(value, word[a], word[b + 1], _BASES[0]).view(np.int64)
    return own, word[a] - word[np.searchsorted(row, own)], h


def _segments(at: np.ndarray, row: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) places in `at` of segments: runs that follow each other with one anchor."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]]) | (least[1:] != least[:-1])]
    begin = np.flatnonzero(new)
    since = np.arange(len(at)) - begin[np.cumsum(new) - 1]
    first = np.flatnonzero(new | (since % SEGMENT == 0))
    return first, np.r_[first[1:], len(at)] - 1


def _pieces(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about PIECE letters each."""
    first, texts, size = 0, [], 0
    for i, value in enumerate(column):
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= PIECE:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def _rows(
    batch: pa.RecordBatch, rows: np.ndarray, columns: list[np.ndarray], schema: str = _KIND
) -> pa.RecordBatch:
    """doc_id and key of rows, beside the columns of the schema."""
    arrays = [batch.column(i).take(pa.array(rows, pa.int64())) for i in (0, 1)]
    names = [c.split() for c in schema.split(", ")]
    arrays += [pa.array(c.astype(np.int32 if k == "int" else np.int64)) for c, (_, k) in zip(columns, names, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", *[n for n, _ in names]])


UNIT, WHOLE, RUNS = 0, 1, 2
_MARK = "kind int, at int, h long"


def _marked(docs: DataFrame, least_words: int, run_words: int) -> DataFrame:
    """Short hashes of units (kind UNIT) and segments (kind WHOLE) of docs (doc_id, key, text); units have no anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _pieces(batch.column(2)):
                row, _, _, hashes = words(texts, _BASES[:1])
                own, place, short = _unit_marks(texts, least_words)
                rows = _rows(batch, own + first, [own * 0 + UNIT, place, short], _MARK)
                yield rows.append_column("anchor", pa.nulls(len(own), pa.int64()))
                at, least, _, _ = _anchors(row, hashes[0], run_words)
                a, b = _segments(at, row, least)
                own, begin, end = row[at[a]], at[a], at[b] + run_words
                h = _sums(hashes[0], begin, end, _BASES[0]).view(np.int64)
                place = begin - np.searchsorted(row, own)
                rows = _rows(batch, own + first, [own * 0 + WHOLE, place, h], _MARK)
                yield rows.append_column("anchor", pa.array(least[a].view(np.int64)))

    return docs.mapInArrow(run, f"doc_id long, key long, {_MARK}, anchor long")


def _hashed(docs: DataFrame, least_words: int, run_words: int) -> DataFrame:
    """Digests of units, segments and runs of docs (doc_id, key, text, wanted): wanted has a number of kind
    and place in words for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _pieces(batch.column(2)):
                row, start, end, hashes = words(texts)
                base = np.cumsum([0, *[len(t) + 1 for t in texts]])
                held = batch.column(3).slice(first, len(texts))
                owner = np.repeat(np.arange(len(texts)), [len(x) for x in held])
                wanted = held.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                known = (owner << 34) | wanted
                # The numbers of kind UNIT are places alone, those of other kinds lie above all places.
                is_unit = wanted < WHOLE << 32
                places: list[set[int]] = [set() for _ in texts]
                for i, w in zip(owner[is_unit].tolist(), wanted[is_unit].tolist(), strict=True):
                    places[i].add(w)
                units = [(i, *u) for i, t in enumerate(texts) for u in _sentences(t, least_words, places[i])]
                own, at, size, a, b = np.array([u[:5] for u in units], np.int64).reshape(-1, 5).T
                halves = np.frombuffer(b"".join(u[5] for u in units), "<i8").reshape(-1, 2).T
                before = np.searchsorted(row, own)
                word = np.searchsorted(end, base[own] + a, "right") - before
                last = np.searchsorted(start, base[own] + b, "left") - before
                yield _rows(batch, own + first, [own * 0, at, size, a, b, word, last, *halves])
                at, least, _, _ = _anchors(row, hashes[0], run_words)
                low, high = _segments(at, row, least)
                begin = at[low] - np.searchsorted(row, row[at[low]])
                for kind in (WHOLE, RUNS):
                    asked = np.isin((row[at[low]] << 34) | ((kind << 32) + begin), known)
                    some, more = low[asked], high[asked]
                    if kind == RUNS:
                        count = more - some + 1
                        some = np.repeat(some - np.cumsum(count) + count, count) + np.arange(count.sum())
                        more = some
                    x, y = at[some], at[more] + run_words
                    own = row[x]
                    word, size = x - np.searchsorted(row, own), y - x
                    both = [_sums(h, x, y, z).view(np.int64) for h, z in zip(hashes, _BASES, strict=True)]
                    columns = [size * 0 + kind, word, size, start[x] - base[own], end[y - 1] - base[own], word, word + size, *both]
                    yield _rows(batch, own + first, columns)

    return docs.mapInArrow(run, f"doc_id long, key long, {_KIND}")


def _wanted_units(marks: DataFrame) -> DataFrame:
    """(key, w): the units that lie in several places."""
    units = marks.where(F.col("kind") == UNIT)
    twice = units.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    return units.join(twice, "h").select("key", (F.lit(UNIT << 32) + F.col("at").cast("long")).alias("w"))


def _wanted_parts(marks: DataFrame, run_words: int) -> DataFrame:
    """(key, w): the segments that lie in several places, and those whose runs may."""
    parts = marks.where(F.col("kind") == WHOLE)
    anchors = parts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("x"), F.max("h").alias("y"))
    anchors = anchors.where("n > 1").select("anchor", (F.col("x") < F.col("y")).alias("several"))
    # Ranks are as wide as the rest of a row: they are taken behind the shuffle.
    parts = parts.join(anchors, "anchor").withColumn("rank", _rank())
    same = parts.groupBy("anchor", "h").agg(F.min("rank").alias("first"), F.max("rank").alias("top"))
    parts = parts.join(same, ["anchor", "h"])
    # A segment that is far enough from its first place goes whole; the others' runs are looked at.
    near = F.col("several") & (F.col("rank") - F.col("first") < F.lit(run_words))
    kinds = F.array_compact(F.array(F.when(F.col("first") < F.col("top"), WHOLE), F.when(near, RUNS)))
    parts = parts.select("key", F.explode(kinds).alias("kind"), F.col("at").cast("long").alias("at"))
    return parts.select("key", (F.shiftleft(F.col("kind").cast("long"), 32) + F.col("at")).alias("w"))


def _rank() -> Column:
    """The id, then 29 bits of a text without one, then the place in words."""
    whole = F.lit(2**62).cast("decimal(19,0)")
    digest = F.when(F.col("doc_id").isNull(), F.col("key").bitwiseAND(F.lit(2**29 - 1))).otherwise(F.lit(0))
    inside = (digest * F.lit(2**32) + F.col("at")).cast("decimal(19,0)")
    return (F.coalesce("doc_id", F.lit(2**63 - 1)).cast("decimal(19,0)") * whole + inside).cast("decimal(38,0)")


def _spans(docs: DataFrame, least_words: int, run_words: int) -> DataFrame:
    """(doc_id, key, start, end, n_words, first_doc_id) of what is removed; key: a digest of id and text.
    Rows that repeat an id and text are one text here, wherever they lie."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    # One after the other, so that their shuffles don't lie on the disks together.
    with collected() as first_pass:
        marks = stored(_marked(texts, least_words, run_words))
    with collected() as lists:
        wanted = stored(_wanted_units(marks)).unionByName(stored(_wanted_parts(marks, run_words)))
    for path in first_pass:
        removed(spark, path)
    with collected() as grouped:
        wanted = stored(wanted.groupBy("key").agg(F.collect_set("w").alias("wanted")))
    for path in lists:
        removed(spark, path)
    asked = texts.join(wanted, "key").dropDuplicates(["key"]).select("doc_id", "key", "text", "wanted")
    units = stored(_hashed(asked, least_words, run_words))
    for path in grouped:
        removed(spark, path)
    whole, last = F.lit(2**62).cast("decimal(19,0)"), F.lit(2**63 - 1)
    units = units.withColumn("rank", _rank())
    first = units.groupBy("d1", "d2").agg(F.min("rank").alias("first"), F.max("rank").alias("top"))
    first = first.where("first < top").select("d1", "d2", "first")
    gone = units.join(first, ["d1", "d2"]).where(F.col("rank") - F.col("first") >= F.col("size"))
    origin = F.nullif(F.floor(F.col("first") / whole).cast("decimal(20,0)").cast("long"), last)
    gone = gone.select("doc_id", "key", "start", "end", "word", "last", origin.alias("origin"))
    text = Window.partitionBy("doc_id", "key").orderBy("start", "end")
    reach = F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    gone = gone.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
    gone = gone.withColumn("span", F.sum("new").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    return gone.groupBy("doc_id", "key", "span").agg(
        F.min("start").cast("long").alias("start"),
        F.max("end").cast("long").alias("end"),
        (F.max("last") - F.min("word")).cast("long").alias("n_words"),
        F.min_by("origin", "start").alias("first_doc_id"),
    )


def repeated(docs: DataFrame, least_words: int = LEAST_WORDS, run_words: int | None = None) -> DataFrame:
    """(doc_id, start, end, n_words, first_doc_id) of each unit to remove, and where it stays; with
    run_words of each span to remove, and where its first unit stays."""
    if run_words is not None:
        return _spans(docs, least_words, run_words).select("doc_id", "start", "end", "n_words", "first_doc_id")
    found = stored(units(docs, least_words))
    place = F.coalesce("doc_id", F.lit(2**63 - 1)).cast("decimal(20,0)") * F.lit(2**32).cast("decimal(11,0)")
    found = found.withColumn("rank", (place + F.col("start")).cast("decimal(38,0)"))
    # Grouped before the shuffle, so a passage in every text is one row a task.
    first = found.groupBy("d1", "d2").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    first = first.where("first < last").select("d1", "d2", "first")
    origin = F.floor(F.col("first") / F.lit(2**32).cast("decimal(11,0)")).cast("decimal(20,0)").cast("long")
    gone = found.join(first, ["d1", "d2"]).where("rank > first")
    return gone.select("doc_id", "start", "end", "n_words", origin.alias("first_doc_id"))


def deduplicated(docs: DataFrame, least_words: int = LEAST_WORDS, run_words: int | None = None) -> DataFrame:
    """docs with the repeated units cut out of the text, and removed (a column of that name is replaced):
    their spans in the original text. Column names that begin with __llm_ are reserved."""
    same = F.col("doc_id").eqNullSafe(F.col("__llm_id"))
    if run_words is None:
        spans = repeated(docs, least_words).groupBy(F.col("doc_id").alias("__llm_id"))
    else:
        spans = _spans(docs, least_words, run_words)
        spans = spans.groupBy(F.col("doc_id").alias("__llm_id"), F.col("key").alias("__llm_key"))
        same &= F.xxhash64("doc_id", "text") == F.col("__llm_key")
    spans = spans.agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__llm_removed"))
    joined = docs.join(spans, same, "left")

    def step(a: Column, s: Column) -> Column:
        before = F.substring(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.struct(s["end"].alias("at"), F.concat(a["out"], before).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    text = F.aggregate(
        "__llm_removed",
        start,
        step,
        lambda a: F.concat(a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    cut = F.when(F.col("__llm_removed").isNull(), F.col("text")).otherwise(text)
    joined = joined.withColumn("text", cut).withColumn("removed", F.col("__llm_removed"))
    return joined.drop("__llm_id", "__llm_key", "__llm_removed")
