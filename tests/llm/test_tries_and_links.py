"""The prefix trie, the signature join and the token alignment against brute force and SQL."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harness.compare import difference
from tests.llm.conftest import SF
from tests.llm.test_operators import linked, shingles
from trailmeter.llm import alignment as A
from trailmeter.llm import queries
from trailmeter.llm import signature_tree as S
from trailmeter.llm.packing import vocabulary
from trailmeter.llm.prefix_trie import beyond, least, minima, prefix_trie, reach

TURNS = "conv_id long, turn long, role string, text string"


def trie(rows):
    """All nodes, by listing every prefix of every rebuilt conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, convs in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(convs) - 1) * (len(p[-1][1]) if p else 0)
            leaves[p[:d]] += children[p] == 0
    out = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out.append((convs[0], len(p), parent, len(convs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df, *options):
    return sorted((tuple(r) for r in prefix_trie(df, *options).collect()), key=str)


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(1)
    rows = []
    for c in [*range(40), *range(100, 130), 205, 206, 1_000_003, -7]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 9, 14])):
            rows.append((c, rng.choice([t, t, t, None, 0]), rng.choice(["u", "a", None]), rng.choice(["x", "yé", "zz", None, ""])))
    rows += [(c, t, "u", "same") for c in (300, 301, 302, 303, 304) for t in range(7)]
    return rows + [(None, 0, "u", "q"), (5, 3, "u", "rep"), (5, 3, "u", "rep")]


@pytest.mark.parametrize("options", [(), (3, 2)])
def test_prefix_trie(spark, talks, options):
    """In one block, and in blocks of three conversations that are ranked by two turns at a time."""
    assert nodes(spark.createDataFrame(talks, TURNS), *options) == trie(talks)


def test_prefix_trie_of_odd_rows(spark, talks):
    df = spark.createDataFrame([(1, 0, "u", "long " * 200_000), (2, 0, "u", "long " * 200_000), (2, 1, None, None)], TURNS)
    extra = df.withColumns({c: F.lit(9) for c in ("place", "at", "rep", "n", "depth", "kind", "low", "weight")})
    assert nodes(extra) == trie([tuple(r) for r in df.collect()])
    assert prefix_trie(df.where("false")).collect() == []
    alone = spark.createDataFrame([(None, 1, "u", "x")], TURNS)
    assert prefix_trie(alone).collect() == []


def test_extents_are_those_of_a_plain_search():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 64, 100):
        lcp = rng.integers(0, 5, n)
        at, depth = rng.integers(0, n, 50), rng.integers(0, 6, 50)
        left, right = reach(minima(lcp), at, depth)
        before, after = beyond(minima(lcp), n // 2, depth)
        for i in range(50):
            a = b = at[i]
            while a > 0 and lcp[a] >= depth[i]:
                a -= 1
            while b + 1 < n and lcp[b + 1] >= depth[i]:
                b += 1
            assert (left[i], right[i]) == (a, b)
            low = [k for k in range(n) if lcp[k] < depth[i]]
            assert before[i] == max([k for k in low if k < n // 2], default=-1)
            assert after[i] == min([k for k in low if k > n // 2], default=-1)
        first, last = np.minimum(at, at[::-1]), np.maximum(at, at[::-1])
        assert (least(minima(lcp), first, last) == [lcp[a : b + 1].min() for a, b in zip(first, last, strict=True)]).all()


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_signature_join"])
def test_queries_equal_their_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), SF, queries.ORACLE[name]) is None


def crowd(n, words=120, edits=8):
    """Copies of one text with single changes, some near to each other only."""
    rng = np.random.default_rng(5)
    texts = {}
    for i in range(n):
        text = [f"w{k}" for k in range(words)]
        for at in rng.choice(words, rng.integers(0, edits), replace=False):
            text[at] = f"x{rng.integers(0, 40)}"
        texts[i] = " ".join(text)
    return texts


@pytest.mark.parametrize("block", [2048, 16])
def test_signature_join_in_a_large_group(spark, block):
    texts = crowd(80)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in S.signature_join(docs, block=block).collect()}
    assert found == linked(texts, 5)[1]


def test_rounds_take_no_exact_components(spark, monkeypatch):
    """Exact components take some five shuffled joins a call: one for the trees and one for the end."""
    rng = random.Random(8)
    words = [str(n) for n in range(100)]
    texts = {}
    for i in range(80):
        text = words.copy()
        for place in rng.sample(range(100), rng.randint(1, 5)):
            text[place] = f"x{rng.random()}"
        texts[i] = " ".join(text)
    calls = []
    exact = S.components
    monkeypatch.setattr(S, "components", lambda links: calls.append(1) or exact(links))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in S.signature_join(docs).collect()}
    assert found == linked(texts, 5)[1] and len(calls) <= 2


def test_merged_labels_are_those_of_linked_nodes(spark):
    def labels(known, links):
        known = known and spark.createDataFrame(known, "node long, component long")
        got = S.merged(known, spark.createDataFrame(links, "a long, b long"))
        return {r["node"]: r["component"] for r in got.collect()}

    assert labels(None, [(1, 3), (2, 3), (8, 9)]) == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}
    old = [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)]
    assert labels(old, [(3, 9), (5, 6)]) == {1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 5: 5, 6: 5}
    # No new link leaves them as they are.
    assert labels(old, []) == dict(old)


def test_signature_join_of_odd_rows(odd, none):
    rows = S.signature_join(odd).collect()
    assert len(rows) == odd.count() and S.signature_join(none).collect() == []
    found = {(r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in rows}
    assert {(2, True, 1), (3, True, 1), (4, False, 4), (5, False, 5), (6, False, 6), (8, True, 8), (9, True, 8)} <= found
    assert {x[2] for x in found if x[0] is None} == {None}


def test_rows_of_one_id_tie_their_sets_together(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(30)) for w in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b), (9, c)]
    found = S.signature_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (5, 1), (7, 1), (9, 9)}


@pytest.mark.parametrize("sides", [1, 2])
def test_dual_traversal_prunes_no_link(sides):
    """All pairs of members at 0.8 or more are left, and pairs of one component are not."""
    texts = crowd(60, 60, 12)
    sets = [sorted({hash(s) % 2**63 for s in shingles(t, 5)}) for t in texts.values()]
    size = np.array([len(s) for s in sets])
    bits = np.zeros((len(sets), S.BITS // 8), np.uint8)
    for i, s in enumerate(sets):
        for token in s:
            bits[i, token % S.BITS // 8] |= 1 << (token % 8)
    spare = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    bits, label = bits.view(np.uint64), np.arange(len(sets)) // 2
    parts = [np.arange(len(sets))] if sides == 1 else [np.arange(0, 25), np.arange(25, 60)]
    parts = [p[np.argsort(size[p], kind="stable")] for p in parts]
    trees = [S.Tree(size[p], spare[p], bits[p], label[p]) for p in parts]
    i, j = S.dual(trees[0], trees[-1], 80)
    found = {tuple(sorted(x)) for x in zip(parts[0][i].tolist(), parts[-1][j].tolist(), strict=True)}
    for a, b in itertools.combinations(range(len(sets)), 2):
        if sides == 2 and (a < 25) == (b < 25):
            continue
        both = len({*sets[a]} & {*sets[b]})
        near = 100 * both >= 80 * (size[a] + size[b] - both)
        assert label[a] == label[b] and (a, b) not in found or label[a] != label[b] and (not near or (a, b) in found)
    assert len(found) < len(sets) * (len(sets) - 1) // 4


def test_common_tokens_go_last_and_links_stay(spark, monkeypatch):
    """A passage in all documents makes no group; whatever the sample tells, links are the same."""
    passage = " ".join(f"p{i}" for i in range(30))
    texts = {i: f"{passage} " + " ".join(f"t{i}-{k}" for k in range(170)) for i in range(12)}
    texts |= {20: texts[3], 21: texts[4] + " more"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    common = S.common_tokens(docs, 5)
    assert len(common) == 26
    base = S.signatures(docs, 5, 80, common).withColumnRenamed("d1", "node")
    assert S.groups(base.dropDuplicates(["node"])).select("node").distinct().count() == 2
    found = {r["doc_id"]: r["component_id"] for r in S.signature_join(docs).collect()}
    monkeypatch.setattr(S, "common_tokens", lambda docs, width: np.zeros(0, np.uint64))
    assert found == {r["doc_id"]: r["component_id"] for r in S.signature_join(docs).collect()} == linked(texts, 5)[1]


ODD_TEXTS = [
    "Hello world, it's a test.", "", None, "  two  spaces ", "naïve café 漢字 😀!", "tab\tand\nlines\r\n",
    "<|endoftext|> and <s> stay text", "a▁b", "x" * 300, "​zero width", "1234567890", "Hello world, it's a test.",
]


def encoded(texts):
    """(ids, end offsets) of both sides, by the tokenizers' own libraries; none where bytes differ."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(vocabulary())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    known = [A.byte_vocabulary(vocabulary()), A.piece_vocabulary(vocabulary("piece_bpe_32k.model"))[1]]
    out = []
    for text in texts:
        sides = []
        for ids, table in zip((first.encode(f" {text}", add_special_tokens=False).ids, second.encode(text or "")), known, strict=True):
            parts = [table[i] for i in ids]
            sides.append((ids, list(itertools.accumulate(map(len, parts))), b"".join(parts)))
        good = bool(text) and all(s[2] == f" {text}".encode() for s in sides)
        out.append([s[:2] for s in sides] if good else [([], []), ([], [])])
    return out


def aligned(texts):
    sides = encoded(texts)
    links = [[(a, b) for a, x in zip(*one, strict=True) for b, y in zip(*two, strict=True) if x == y] for one, two in sides]
    count = Counter(p for own in links for p in own)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for ((a, x), (b, y)), own in zip(sides, links, strict=True):
        ends = sorted({*x} & {*y})
        groups, last = [], 0
        for end in ends:
            left = ",".join(str(i) for i, e in zip(a, x, strict=True) if last < e <= end)
            right = ",".join(str(i) for i, e in zip(b, y, strict=True) if last < e <= end)
            groups.append(f"{left}|{right}")
            last = end
        text = ";".join(groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((len(a), len(b), len(ends), len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), digest))
    return out


def test_alignment(spark, texts):
    some = [*ODD_TEXTS, *[texts[i] for i in sorted(texts)[:25]]]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    found = [tuple(r)[1:] for r in sorted(A.token_alignment(docs).collect())]
    assert found == aligned(some)


def test_alignment_of_odd_rows(spark, odd, none):
    rows = A.token_alignment(odd).collect()
    assert len(rows) == odd.count() and A.token_alignment(none).collect() == []
    empty = [tuple(r)[1:] for r in rows if r["doc_id"] in (4, 5)]
    assert empty == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert len({tuple(r) for r in rows if r["doc_id"] == 8}) == 1


def test_links_of_both_kinds(spark):
    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    sides = encoded(ODD_TEXTS)
    overlap, group = set(), set()
    for d, ((a, x), (b, y)) in enumerate(sides):
        both = sorted({*x} & {*y})
        for (i, s), (j, t) in itertools.product(enumerate(x), enumerate(y)):
            begin = max(x[i - 1] if i else 0, y[j - 1] if j else 0)
            if min(s, t) > begin:
                overlap.add((d, i, j, a[i], b[j], min(s, t) - begin, s == t))
            if next(e for e in both if e >= s) == next(e for e in both if e >= t):
                group.add((d, i, j, a[i], b[j], None, s == t))
    assert {tuple(r) for r in A.links(docs).collect()} == overlap
    assert {tuple(r) for r in A.links(docs, "group").collect()} == group
    with pytest.raises(ValueError, match="kind"):
        A.links(docs, "other")


def test_products_of_rows_equal_dense_ones():
    rng = np.random.default_rng(3)
    for block in (1, 5, 1 << 20):
        x, y = (rng.random((7, 9)) < 0.4, rng.random((9, 6)) < 0.4)
        a, b = (A.Csr(np.r_[0, np.cumsum(m.sum(axis=1))], np.nonzero(m)[1], m.shape[1]) for m in (x, y))
        dense = np.zeros((7, 6), int)
        for i, j, n in A.product(a, b, block):
            dense[i, j] += n
        assert (dense == x.astype(int) @ y.astype(int)).all()
        back = A.transposed(A.transposed(a))
        assert (back.indptr == a.indptr).all() and (back.indices == a.indices).all()


def test_pairs_that_end_together_are_bounded_by_the_vocabularies():
    a, b = [b" the", b"he", b"x"], [b"he", b"e", b"the"]
    suffixes = {(x, y) for x in a for y in b if x.endswith(y) or y.endswith(x)}
    assert len(suffixes) <= A.most_pairs(a, b)
