"""Cross-tokenizer alignment by products of token-byte incidence matrices in compressed sparse rows.

Each text, with a space before it, is encoded by a byte-level BPE (A) and a piece model with byte fallback
(B, which adds the space itself). A row of an incidence matrix is a token, a column a byte of the text. The
row products of A and the transpose of B (Gustavson) give the token pairs that overlap and by how many
bytes; the row products of the two token-group matrices give the pairs that share a group. A group ends
where a token of A and one of B end together.

Pairs of tokens that end together lie in the same bytes, so the shorter one's bytes are a suffix of the
longer one's. A corpus of any size therefore has at most as many different pairs of ids as the two
vocabularies have bytes (`most_pairs`, about 600,000), and their counts may be sent to all tasks.

Nulls, ties and odd rows: a null or empty text, and one whose joined token bytes are not those of the text
(B writes U+2581 as a space), has no tokens: zeros and an empty string; rows without id, of one id or
repeated are each counted and returned; pairs that tie for the highest count are all best; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmeter.llm.common import stored
from trailmeter.llm.packing import _byte_letters as byte_letters
from trailmeter.llm.packing import encoder, vocabulary

#: Bytes of text whose matrices are built at once; a longer document is one piece of its own.
PIECE = 1 << 20
#: Entries of a product that are held at once.
BLOCK = 1 << 21
_pieces: dict[str, tuple] = {}


class Csr(NamedTuple):
    """A sparse matrix of ones: the columns of row i are indices[indptr[i]:indptr[i + 1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    width: int


def token_bytes(lengths: np.ndarray) -> Csr:
    """Tokens that follow each other without a gap, by their lengths in bytes."""
    indptr = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return Csr(indptr, np.arange(indptr[-1]), int(indptr[-1]))


def token_groups(group: np.ndarray, n_groups: int) -> Csr:
    """Tokens by the one group each lies in."""
    return Csr(np.arange(len(group) + 1), group, n_groups)


def transposed(m: Csr) -> Csr:
    rows = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))
    indptr = np.concatenate([[0], np.cumsum(np.bincount(m.indices, minlength=m.width))]).astype(np.int64)
    return Csr(indptr, rows[np.argsort(m.indices, kind="stable")], len(m.indptr) - 1)


def product(a: Csr, b: Csr, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of the entries of a times b, for blocks of rows of a.

    Each row of the result is the sum of the rows of b that a's row names. Blocks hold about `block` terms;
    a single row with more is a block of its own.
    """
    terms = np.diff(b.indptr)[a.indices]
    upto = np.concatenate([[0], np.cumsum(terms)])[a.indptr]
    first, rows = 0, len(a.indptr) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + block, "right")) - 1)
        held = slice(a.indptr[first], a.indptr[last])
        many = terms[held]
        row = np.repeat(np.repeat(np.arange(first, last), np.diff(a.indptr[first : last + 1])), many)
        begin = np.repeat(b.indptr[a.indices[held]] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
        key = row * max(1, b.width) + b.indices[begin + np.arange(len(row))]
        if (key[1:] < key[:-1]).any():
            key = np.sort(key)
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        value = np.diff(np.concatenate([new, [len(key)]]))
        yield key[new] // max(1, b.width), key[new] % max(1, b.width), value
        first = last


def byte_vocabulary(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary (tokenizers file)."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    letters = {c: b for b, c in byte_letters().items()}
    special = {t["content"] for t in model["added_tokens"]}
    vocab = model["model"]["vocab"]
    out = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in model["added_tokens"])]))
    for token, i in vocab.items():
        out[i] = token.encode() if token in special else bytes(letters[c] for c in token)
    return out


def piece_vocabulary(path: str):
    """A piece model and the bytes of each of its ids: U+2581 is a space, a byte piece is its byte."""
    if path not in _pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        out = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        _pieces[path] = model, out
    return _pieces[path]


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """No more pairs of ids can end together: each token has a suffix for each of its bytes."""
    return sum(map(len, a)) + sum(map(len, b))


class Tokens(NamedTuple):
    """The tokens of several texts, one text after another: ids, text of each token, end of each in bytes."""

    ids: np.ndarray
    text: np.ndarray
    ends: np.ndarray


class Aligner:
    """Both tokenizers with the lengths and printed forms of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        self.code = encoder(byte_path)
        self.bytes_a = byte_vocabulary(byte_path)
        self.model, self.bytes_b = piece_vocabulary(piece_path)
        self.sizes = [np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b)]
        # An id as it is written before a token of its own side, and at the end of a group.
        self.written = [
            np.array([f"{i}{mark}" for mark in marks for i in range(len(v))], object)
            for v, marks in ((self.bytes_a, ",|"), (self.bytes_b, ",;"))
        ]

    def encode(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        """Tokens of both sides; a text whose joined bytes differ from the text's has none."""
        whole = [f" {t}".encode() for t in texts]
        sides = [
            (self.code.encode_ordinary_batch([f" {t}" for t in texts], num_threads=1), self.bytes_a),
            (self.model.encode(texts, num_threads=1) if texts else [], self.bytes_b),
        ]
        good = np.array([bool(t) for t in texts], bool)
        for ids, known in sides:
            for i, w in enumerate(whole):
                good[i] = good[i] and b"".join([known[k] for k in ids[i]]) == w
        out = []
        for (ids, _), sizes in zip(sides, self.sizes, strict=True):
            count = np.array([len(x) if g else 0 for x, g in zip(ids, good, strict=True)], np.int64)
            flat = np.fromiter((k for x, g in zip(ids, good, strict=True) if g for k in x), np.int64, count.sum())
            out.append(Tokens(flat, np.repeat(np.arange(len(texts)), count), np.cumsum(sizes[flat])))
        return out[0], out[1]

    def overlaps(self, a: Tokens, b: Tokens) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in a, place in b, bytes in common)."""
        left, right = token_bytes(self.sizes[0][a.ids]), token_bytes(self.sizes[1][b.ids])
        return product(left, transposed(right))

    def groups(self, a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group of each token of a, of each of b, end of each group)."""
        ends = np.intersect1d(a.ends, b.ends, assume_unique=True)
        return np.searchsorted(ends, a.ends), np.searchsorted(ends, b.ends), ends

    def shared(self, a: Tokens, b: Tokens) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in a, place in b, 1) of all pairs in one group; a group may have many."""
        left, right, ends = self.groups(a, b)
        return product(token_groups(left, len(ends)), transposed(token_groups(right, len(ends))))

    def digests(self, a: Tokens, b: Tokens, n: int) -> list[str]:
        """For each text the SHA-256 of its groups as `a1,a2|b1;a3|b2,b3`, empty without tokens."""
        left, right, ends = self.groups(a, b)
        text = a.text[np.searchsorted(a.ends, ends)] if len(ends) else np.zeros(0, np.int64)
        last = [np.isin(x.ends, ends, assume_unique=True) for x in (a, b)]
        of_a = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=len(ends)))]).astype(np.int64)
        of_b = np.concatenate([[0], np.cumsum(np.bincount(right, minlength=len(ends)))]).astype(np.int64)
        line = np.empty(len(a.ids) + len(b.ids), object)
        line[np.arange(len(a.ids)) + of_b[left]] = self.written[0][a.ids + len(self.bytes_a) * last[0]]
        line[np.arange(len(b.ids)) + of_a[right + 1]] = self.written[1][b.ids + len(self.bytes_b) * last[1]]
        cut = np.searchsorted(text, np.arange(n + 1))
        cut = of_a[cut] + of_b[cut]
        out = []
        for i in range(n):
            joined = "".join(line[cut[i] : cut[i + 1]].tolist())[:-1]
            out.append(hashlib.sha256(joined.encode()).hexdigest() if joined else "")
        return out


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about PIECE letters each; null is empty."""
    first, texts, size = 0, [], 0
    for i, value in enumerate(column):
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= PIECE:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def links(
    docs: DataFrame, kind: str = "overlap", byte_path: str | None = None, piece_path: str | None = None
) -> DataFrame:
    """(doc_id, a_place, b_place, a_id, b_id, n_bytes, ends_together) of all token pairs of each text: kind
    "overlap" those with bytes in common, "group" those of one group (n_bytes is null)."""
    paths = byte_path or vocabulary(), piece_path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*paths)
        for batch in batches:
            for first, texts in _texts(batch.column(1)):
                a, b = aligner.encode(texts)
                starts = [np.searchsorted(x.text, np.arange(len(texts))) for x in (a, b)]
                for i, j, n in aligner.overlaps(a, b) if kind == "overlap" else aligner.shared(a, b):
                    row = a.text[i]
                    columns = (i - starts[0][row], j - starts[1][row], a.ids[i], b.ids[j])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(row + first)),
                            *map(pa.array, columns),
                            pa.array(n, pa.int64()) if kind == "overlap" else pa.nulls(len(n), pa.int64()),
                            pa.array(a.ends[i] == b.ends[j]),
                        ],
                        ["doc_id", "a_place", "b_place", "a_id", "b_id", "n_bytes", "ends_together"],
                    )

    if kind not in ("overlap", "group"):
        raise ValueError(f"kind is overlap or group, not {kind}")
    schema = "doc_id long, a_place long, b_place long, a_id long, b_id long, n_bytes long, ends_together boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _aligned(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs): pairs has, for each link whose tokens end
    together, its two ids as one number of 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*paths)
        for batch in batches:
            for first, texts in _texts(batch.column(1)):
                n = len(texts)
                a, b = aligner.encode(texts)
                both = [(i, j) for i, j, _ in aligner.overlaps(a, b)] or [(np.zeros(0, np.int64),) * 2]
                i, j = (np.concatenate(x) for x in zip(*both, strict=True))
                ends = a.ends[i] == b.ends[j]
                i, j = i[ends], j[ends]
                pair = (a.ids[i] * len(aligner.bytes_b) + b.ids[j]).astype("<u4")
                cut = np.searchsorted(a.text[i], np.arange(n + 1))
                group_ends = aligner.groups(a, b)[2]
                groups = np.bincount(a.text[np.searchsorted(a.ends, group_ends)], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        *[pa.array(np.bincount(x.text, minlength=n)) for x in (a, b)],
                        pa.array(groups),
                        pa.array(np.diff(cut)),
                        pa.array(aligner.digests(a, b, n), pa.string()),
                        pa.array([pair[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
                )

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, pair) of a binary column of pairs."""
    held = [np.frombuffer(x.as_buffer(), "<u4") for x in column]
    return np.repeat(np.arange(len(held)), [len(x) for x in held]), np.concatenate(held) if held else np.zeros(0, "<u4")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): links of each pair of ids, added up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                pair, n = np.unique(_flat(batch.column(0).slice(at, 1000))[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n)], ["pair", "n"])

    rows = aligned.select("pairs").mapInArrow(run, "pair long, n long")
    return rows.groupBy("pair").agg(F.sum("n").alias("n"))


def token_alignment(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of docs (doc_id,
    text). Texts are encoded once; the links of a text stay with its row, so nothing is joined."""
    paths = byte_path or vocabulary(), piece_path or vocabulary("piece_bpe_32k.model")
    aligned = stored(_aligned(docs, paths))
    bytes_b = piece_vocabulary(paths[1])[1]
    width, bound = len(bytes_b), most_pairs(byte_vocabulary(paths[0]), bytes_b)
    counts = pair_counts(aligned).limit(bound + 1).toArrow()
    if counts.num_rows > bound:
        raise ValueError("more pairs of tokens end together than their bytes allow")
    order = np.argsort(counts["pair"].to_numpy())
    pair, n = counts["pair"].to_numpy()[order], counts["n"].to_numpy()[order]
    best = np.zeros(width, np.int64)
    np.maximum.at(best, pair % width, n)
    known = docs.sparkSession.sparkContext.broadcast((pair, n, n == best[pair % width]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, top = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                row, own = _flat(part.column(6))
                place = np.searchsorted(pair, own)
                sums = np.zeros((2, part.num_rows), np.int64)
                np.add.at(sums[0], row, top[place])
                np.add.at(sums[1], row, n[place])
                columns = [*part.columns[:5], *map(pa.array, sums), part.column(5)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = ", ".join(f"{c} long" for c in names[:-1]) + ", groups_sha256 string"
    return aligned.mapInArrow(run, schema)
