"""Word shingles of Arrow string columns as 64-bit hashes, by numpy over whole batches of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEEDED = np.random.Generator(np.random.PCG64(20240607))
#: A random 64-bit code for each byte; capital letters A-Z share the codes of a-z.
CODES = _SEEDED.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CODES[65:91] = CODES[97:123]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACES = _SEEDED.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes of text that are hashed at once; a longer document is one piece of its own.
PIECE = 1 << 20
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves every bit of the output."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 to the 64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + 1)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over a string column, about PIECE bytes each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, "right")) - 1)
        end = min(end, len(column), row + 60_000)
        yield row, end, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, hash of each word), words in order; A-Z count as a-z."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(CODES[data] * up[: len(data)], out=total[1:])
    value = mix((total[last] - total[first]) * down[first])
    return np.searchsorted(offsets[1:], first, "right"), value


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles, by row and then hash.

    A row with fewer words than width has the whole sequence as its one shingle, a row without words none.
    """
    row, word = words(data, offsets)
    n = len(row)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    keep = np.zeros(0, np.int64)
    value = np.zeros(0, np.uint64)
    if n >= width:
        full = np.flatnonzero(row[: n - width + 1] == row[width - 1 :])
        value = np.full(len(full), width, np.uint64)
        for j in range(width):
            value += word[full + j] * _PLACES[j]
        keep = row[full]
    short = (counts > 0) & (counts < width)
    if short.any():
        ends = np.cumsum(counts)
        few = np.flatnonzero(short)
        first = ends[few] - counts[few]
        whole = counts[few].astype(np.uint64)
        for j in range(width - 1):
            has = counts[few] > j
            whole[has] += word[first[has] + j] * _PLACES[j]
        keep, value = np.concatenate([keep, few]), np.concatenate([value, whole])
    value = mix(value)
    order = np.argsort(value)
    order = order[np.argsort(keep[order].astype(np.uint16), kind="stable")]
    keep, value = keep[order], value[order]
    new = np.ones(len(keep), bool)
    new[1:] = (keep[1:] != keep[:-1]) | (value[1:] != value[:-1])
    return keep[new], value[new]
