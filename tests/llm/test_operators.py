"""Each operator against a brute-force version, and on odd rows."""

import hashlib
import itertools
import os
import random
import re
import uuid
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmeter.llm import near_dedup, queries, substring_dedup
from trailmeter.llm.common import collected, components, ranked, scratch_dir, table
from trailmeter.llm.decontaminate import Matcher, budget, contaminated, decontaminated, distance, masks, normal
from trailmeter.llm.language_id import identified, page_evidence
from trailmeter.llm.near_dedup import likely_similarity, near_duplicates, registers
from trailmeter.llm.packing import END, encoder, knapsack, packed, patterns, vocabulary
from trailmeter.llm.quality import passed, quality
from trailmeter.llm.secret_scan import redacted, secrets
from trailmeter.llm.shards import sharded
from trailmeter.llm.substring_dedup import deduplicated, repeated
from trailmeter.llm.token_counts import Rollup, word_counts
from trailmeter.llm.toxicity import kernel, learned, toxicity
from tests.llm.conftest import SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, width):
    w = WORDS.findall(lower(text))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def linked(texts, width):
    """id -> smallest id that can be reached, by all pairs."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    label = {i: i for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y) and label[a] != label[b]:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {i: new if v == old else v for i, v in label.items()}
    return sets, label


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(documents, texts, width):
    sets, label = linked(texts, width)
    got = {r["doc_id"]: r for r in near_duplicates(documents, width=width).collect()}
    assert {i: (len(sets[i]), label[i], label[i] == i) for i in texts} == {
        i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()
    }


def test_near_duplicates_in_a_large_group(spark):
    """Copies of one text with single changes, some near to each other only: no link is lost."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 8), replace=False):
            words[at] = f"x{rng.integers(0, 40)}"
        texts[i] = " ".join(words)
    _, label = linked(texts, 4)
    got = near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), width=4)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == label


def test_near_duplicates_of_odd_rows(odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == 13 and near_duplicates(none).count() == 0
    got = defaultdict(set)
    for r in rows:
        got[r["doc_id"]].add((r["component_id"], r["kept"], r["n_shingles"] > 0))
    assert got[2] == got[3] == {(1, False, True)} and got[9] == {(8, False, True)} and got[8] == {(8, True, True)}
    assert got[4] == {(4, True, False)} and got[5] == {(5, True, False)}
    assert {x[:2] for x in got[None]} == {(None, True)}


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    for shared in (100, 400, 480):
        common = rng.integers(0, 2**63, shared, dtype=np.uint64)
        sides = [np.r_[common, rng.integers(0, 2**63, 500 - shared, dtype=np.uint64)] for _ in range(2)]
        u, v = (registers(np.zeros(500, np.int64), s, 1, 2048) for s in sides)
        found = likely_similarity(u, v, np.array([500.0]), np.array([500.0]))[0]
        assert abs(found - shared / (1000 - shared)) < 0.05
        both = np.unique(np.concatenate(sides))
        merged = registers(np.zeros(len(both), np.int64), both, 1, 2048)
        assert (merged == np.maximum(u, v)).all()


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 9), (9, 8), (20, 21)] + [(30 + i, 31 + i) for i in range(30)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([1, 2, 3, 4], 1), 8: 8, 9: 8, 10: 8, 20: 20, 21: 20, **dict.fromkeys(range(30, 61), 30)}


def test_ranks_are_gapless(spark):
    df = spark.range(1000).select((F.col("id") % 7 == 0).alias("k"), "id")
    out = ranked(df, ["k"], [F.col("id")], "r", F.pmod(F.xxhash64("id"), F.lit(9)), 9).collect()
    for k in (True, False):
        assert sorted(r["r"] for r in out if r["k"] == k) == list(range(sum(r["k"] == k for r in out)))


def test_toxicity(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rows = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    truth = [(rows[r["doc_id"]]["score"], r["toxic"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    pairs = [(a, b) for a, x in truth if x for b, y in truth if not y]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) > 0.95


def test_toxicity_from_few_labels(spark):
    """Ten toxic texts are enough to learn words that lie in four of them and in no clean one."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    truth = [(rows[r["doc_id"]]["predicted"], r["toxic"]) for r in labels.where("toxic in (0, 1)").collect()]
    found, missed = sum(p for p, t in truth if t), sum(not p for p, t in truth if t)
    assert found > missed and sum(p for p, t in truth if not t) <= 3
    assert learned([("common", 1, 1)], 1, 1) is not None and learned([("word", 3, 0)], 3, 0) is None


def test_toxicity_without_labels_and_of_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity(odd, labels).collect()} == {0.0}
    assert toxicity(none, labels).count() == 0


def test_kernel_tolerates_inserted_letters():
    near, far = kernel(["stupxid", "granite"], ["stupid"])[:, 0]
    assert near > 0.45 > far and abs(kernel(["stupid"], ["stupid"])[0, 0] - 1) < 1e-5


def base_counts(text):
    text = text or ""
    w = WORDS.findall(text)
    seen, double = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            double += line in seen
            seen.add(line)
    places = defaultdict(list)
    for i in range(len(w) - 7):
        places[tuple(w[i : i + 8])].append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), double, len(covered)


def test_quality(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    good = {r["doc_id"]: r["quality"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = {r["doc_id"]: r for r in quality(docs).collect()}
    for i, r in rows.items():
        counts = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert counts == base_counts(texts[i])
        assert r["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r["kept"] and r["base_failed"])
    judged = {i: r["kept"] for i, r in rows.items() if i in good and not r["base_failed"]}
    clean = [k for i, k in judged.items() if good[i]]
    junk = [k for i, k in judged.items() if not good[i]]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.4 * len(junk)


def test_quality_of_odd_rows(odd, none):
    rows = quality(odd).collect()
    assert len(rows) == 13 and quality(none).count() == 0
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (4, 5, 6, 8, None))


def test_repeated_units(documents, texts):
    unit = re.compile(r"[^\n.!?]+[.!?]*")
    first, gone = {}, set()
    for i in sorted(texts):
        for m in unit.finditer(texts[i]):
            words = m.group().lower().split()
            if len(words) >= 8:
                if tuple(words) in first:
                    gone.add((i, m.start(), m.end(), len(words), first[tuple(words)]))
                else:
                    first[tuple(words)] = i
    assert {tuple(r) for r in repeated(documents).collect()} == gone and gone
    out = {r["doc_id"]: r for r in deduplicated(documents).collect()}
    for i, text in texts.items():
        for _, a, b, *_ in sorted((g for g in gone if g[0] == i), reverse=True):
            text = text[:a] + text[b:]
        assert out[i]["text"] == text


def test_repeated_units_of_odd_rows(odd, none):
    assert {r["doc_id"] for r in repeated(odd).collect()} == {2}
    assert deduplicated(odd.drop("removed")).count() == 13 and repeated(none).count() == 0


def test_repeated_runs_of_words(documents, texts):
    """Each run of 50 words that is seen earlier goes, wherever it lies, and each sentence that went before."""
    token = re.compile(r"\S+")
    first, want = {}, defaultdict(set)
    for i in sorted(texts):
        found = list(token.finditer(texts[i]))
        for at in range(len(found) - 49):
            run = found[at : at + 50]
            place = first.setdefault(" ".join(m.group().lower() for m in run), (i, at))
            if place[0] != i or at - place[1] >= 50:
                want[i].update(range(run[0].start(), run[-1].end()))
    for r in repeated(documents).collect():
        want[r["doc_id"]].update(range(r["start"], r["end"]))
    rows, got = queries.op4_substring_dedup(documents.sparkSession, SF).collect(), defaultdict(set)
    for r in rows:
        assert not got[r["doc_id"]] & set(range(r["start"], r["end"])) and r["first_doc_id"] <= r["doc_id"]
        got[r["doc_id"]].update(range(r["start"], r["end"]))
    assert want and all(places <= got[i] for i, places in want.items())


def test_repeated_lists_and_texts_without_spaces(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3_000)]
    poem = "\n".join(" ".join(words[3 * i : 3 * i + 3]) for i in range(4))
    long, han = "".join(words[100:300]), "".join(chr(0x4E00 + rng.randrange(9_000)) for _ in range(80))
    once = " ".join(words[400:460])
    rows = [(1, f"own\n{poem}\nstart"), (2, f"other\n{poem}\nend"), (3, f"xq{long}zz"), (4, f"other{long[3:]}"),
            (5, f"\u4e00{han}"), (6, han), (None, f"a {once}"), (None, f"b c {once}"), (7, once + " " + once), (8, "x " * 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert repeated(docs).count() == 0
    out = sorted(deduplicated(docs, run_words=50).collect(), key=lambda r: r["doc_id"] or 99)
    left = [r["text"] for r in out]
    assert left[:2] == [rows[0][1], "other\n\nend"] and left[2] == rows[2][1] and len(left[3]) < 60
    assert left[4:6] == [rows[4][1], ""] and left[6].split() == words[400:460] and left[7].split() == ["x"] * 50
    assert sorted(t.strip() for t in left[8:]) == ["a", "b c"]


def test_lists_of_the_first_pass_go(spark):
    """Of the frames in between only the digests are read to the end."""
    line = "one and the same line of some more than eight words in all"
    docs = spark.createDataFrame([(n, f"{line}\nown {n}") for n in range(3)], "doc_id long, text string")
    with collected() as made:
        rows = repeated(docs, run_words=50).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2] and len(made) == 5
    assert [p for p in made if os.path.exists(p.removeprefix("file:"))] == made[-1:]


def test_short_repeated_lines_go(spark):
    line = "Subscribe to our newsletter now"
    rows = [(1, f"one two three four\n{line}\nfive"), (2, f"six seven\n  {line.upper()}  \neight"), (3, f"{line}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed", F.lit("clash"))
    out = {r["doc_id"]: r for r in deduplicated(docs, run_words=50).collect()}
    assert [out[i]["text"] for i in (1, 2, 3)] == [rows[0][1], "six seven\n\neight", ""]
    assert [len(out[i]["removed"] or ()) for i in (1, 2, 3)] == [0, 1, 1]


def test_paragraphs_with_short_lines_go(spark):
    block = "a\nb c\nd"
    rows = [(1, f"own text here\n\n{block}\n\nend of one"), (2, f"other words\n\n{block}\n\nlast of two")]
    out = deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), run_words=50).collect()
    assert {r["doc_id"]: r["text"] for r in out} == {1: rows[0][1], 2: "other words\n\n\n\nlast of two"}


def test_runs_of_odd_rows(odd, none):
    rows = repeated(odd, run_words=50).collect()
    assert [(r["doc_id"], r["first_doc_id"]) for r in rows] == [(2, 1)]
    assert repeated(none, run_words=50).count() == 0 == deduplicated(none, run_words=50).count()
    out = deduplicated(odd, run_words=50).collect()
    assert len(out) == 13 and {r["text"] for r in out if r["doc_id"] == 2} == {""}


def test_passages_between_other_texts_are_found(spark):
    """Passages of 51 to 90 words at any place of longer texts, two of them with ends of their own."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    shared = [[word() for _ in range(n)] for n in (51, 60, 90)]
    texts, want = {}, defaultdict(set)
    for i in range(24):
        parts = [word() for _ in range(rng.randrange(40, 200))]
        passage = shared[i % 3][: -5 if i % 6 == 3 and i % 3 == 2 else None]
        texts[i] = " ".join([*parts, *passage, *[word() for _ in range(rng.randrange(40, 200))]])
        if i >= 3:
            begin = len(" ".join(parts)) + 1
            want[i] = set(range(begin, begin + len(" ".join(passage))))
    found = defaultdict(set)
    for r in repeated(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), run_words=50).collect():
        found[r["doc_id"]].update(range(r["start"], r["end"]))
    assert found == want


def base_spans(text):
    text, out = text or "", []
    kinds = [
        (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
        (r"AKIA[A-Z0-9]+", 18),
        (r"[0-9a-f]+", 16),
    ]
    for k, (pattern, least) in enumerate(kinds):
        for m in re.finditer(pattern, text):
            if len(m[2] if k == 0 else m[0]) >= least:
                out.append((m.start(), k, m.end()))
    names = ["assign", "access", "hex"]
    return [sum(x[1] == k for x in out) for k in range(3)], [f"{names[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_secrets(documents, odd, none):
    for docs in (documents, odd):
        texts = defaultdict(set)
        for r in docs.select("doc_id", "text").collect():
            texts[r["doc_id"]].add(r["text"])
        for r in secrets(docs).collect():
            results = [base_spans(t) for t in texts[r["doc_id"]]]
            digests = [(c, hashlib.sha256(",".join(s).encode()).hexdigest()) for c, s in results]
            assert ([r["n_assign"], r["n_access"], r["n_hex"]], r["base_sha256"]) in digests
            assert any(set(s) <= set(r["spans"].split(",")) for _, s in results)
    assert secrets(none).count() == 0
    clean = {r["doc_id"]: r["text"] for r in redacted(odd).collect()}
    assert clean[10] == "\U0001f600 é [SECRET] [SECRET]\nx\nx" and clean[4] is None
    assert all(not base_spans(t)[1] for t in clean.values())


def test_ownership_separates_copied_examples(spark):
    copied, own = "Zx9kQ2mmA7bLw4TtYy81Kd", "Pq8sR3nnB6cMv5UuXx72Je"
    rows = [(i, f"say {copied} end", "en", f"s{i}") for i in range(6)] + [(9, f"say {own} end", "en", "s9")]
    got = {r["doc_id"]: r for r in secrets(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[0]["spans"] == "" and got[0]["n_example"] == 1
    assert got[9]["spans"] == f"token:4:{4 + len(own)}" and got[9]["n_live"] == 1


def check_packing(rows, texts):
    """Every id of every text in one piece; sequences gapless and within their length."""
    code, by = encoder(vocabulary()), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for i, text in texts.items():
        ids = np.array([*code.encode(text or "", allowed_special="all"), END], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    return sum(r["length"] for r in rows) / (2048 * len(sequences))


def test_packing(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert check_packing(packed(docs).collect(), texts) > 0.98


def test_packing_of_odd_rows(odd, none):
    rows = packed(odd).collect()
    assert len({r["doc_id"] for r in rows}) == 11 and packed(none).count() == 0
    single = odd.where("doc_id is not null and doc_id <> 8")
    check_packing(packed(single).collect(), {r["doc_id"]: r["text"] for r in single.collect()})


def test_ids_are_those_of_the_tokenizers_library(texts):
    from tokenizers import Tokenizer

    sample = [t or "" for t in texts.values()]
    sample += ["<|endoftext|> a<|endoftext|>", "  two  spaces\n\n\ttab", "naïve ß Ñ \U0001f600 ​ x", "don't I'LL 12345 ½ ²", "日本語 한국어 العربية"]
    want = [e.ids for e in Tokenizer.from_file(vocabulary()).encode_batch(sample, add_special_tokens=False)]
    code = encoder(vocabulary())
    assert [code.encode(t, allowed_special="all") for t in sample] == want


def test_patterns_cover_demand():
    demand = {3: 40, 5: 33, 7: 21, 60: 9, 64: 4, 128: 2}
    out = patterns(demand, 128)
    assert all(sum(s * n for s, n in p.items()) <= 128 for p, _ in out)
    assert all(sum(p.get(s, 0) * t for p, t in out) >= n for s, n in demand.items())
    assert sum(t for _, t in out) <= -(-sum(s * n for s, n in demand.items()) // 128) + 2
    value, counts = knapsack(np.array([3, 5]), np.array([3.1, 5.0]), 11)
    assert counts.tolist() == [2, 1] and value == pytest.approx(11.2)


def check_shards(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(shards))
    for held in by.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    return [sum(r["size"] for r in held) for held in by.values()]


def test_sharding(documents, texts):
    rows = sharded(documents, shards=7).collect()
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    sizes, longest = check_shards(rows, 7), max(r["size"] for r in rows)
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 3 * longest


def test_sharding_of_odd_rows(odd, none):
    assert sum(check_shards(sharded(odd).collect(), 40)) > 0 and sharded(none).count() == 0


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_distance_is_that_of_the_table():
    rng = np.random.default_rng(2)
    for _ in range(200):
        pattern, text = ("".join(rng.choice(list("abc"), n)) for n in rng.integers(1, 30, 2))
        assert distance(masks(pattern), len(pattern), text)[0] == plain_distance(pattern, text)


def test_contamination(spark, documents, texts):
    items = table(spark, SF, "benchmark")
    some = items.limit(12)
    want = set()
    for item in some.collect():
        pattern = normal(item["text"])
        for i, text in texts.items():
            if len(text) < 4_000:
                d = plain_distance(pattern, normal(text))
                if d <= budget(len(pattern), 0.08):
                    want.add((i, item["item_id"], d))
    got = {tuple(r) for r in contaminated(documents.where("length(text) < 4000"), some).collect()}
    assert got == want
    whole = {(r["doc_id"], r["item_id"]) for r in contaminated(documents, items).collect()}
    exact = {(i, x["item_id"]) for x in items.collect() for i, t in texts.items() if normal(x["text"]) in normal(t)}
    assert exact and exact <= whole


def test_contamination_with_edits():
    item = "the quick brown fox jumps over the lazy dog while seven wizards brew strong coffee at night"
    matcher = Matcher([(1, item), (2, ""), (3, "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz")], 0.08)
    assert matcher.hits("intro " + item.replace("lazy", "lxzy").replace("brew", "brw") + " outro") == {1: 2}
    assert matcher.hits("intro") == matcher.hits(None) == {}


def test_contamination_of_odd_rows(odd, none, spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two")], "item_id long, text string")
    assert sorted(str(r["doc_id"]) for r in contaminated(odd, items).collect()) == ["8", "8", "9", "None"]
    assert contaminated(none, items).count() == 0 and contaminated(odd, items.where("false")).count() == 0


def test_token_rollup(spark):
    def change(*rows):
        return spark.createDataFrame(list(rows), "op string, doc_id long, source string, lang string, version string, tokens long")

    rollup = Rollup(spark, f"{scratch_dir(spark)}/{uuid.uuid4().hex}")
    rollup.commit(1, change(("insert", 1, "a", "en", "v1", 10), ("insert", 2, None, "en", "v1", 5), ("insert", 3, "a", None, "v1", 7)))
    for _ in range(2):
        rollup.commit(2, change(("revise", 1, "a", "en", "v2", 12), ("delete", 3, None, None, None, 0), ("delete", 99, None, None, None, 0)))
    rollup.commit(3, change().where("false"))
    assert {tuple(r) for r in rollup.totals().collect()} == {("a", "en", "v2", 12, 1), (None, "en", "v1", 5, 1)}
    with pytest.raises(ValueError, match="older"):
        rollup.commit(1, change())


def test_token_rollup_is_opened_again(spark):
    """Batches are known from storage; one that was cut off before its mark is not, and is committed anew."""
    schema = "op string, doc_id long, source string, lang string, version string, tokens long"
    folder = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    Rollup(spark, folder).commit(1, spark.createDataFrame([("insert", 1, "a", "en", "v", 10), ("insert", 2, "a", "en", "v", 5)], schema))
    second = spark.createDataFrame([("delete", 1, None, None, None, 0), ("revise", 2, "a", "en", "v", 4)], schema)
    Rollup(spark, folder).commit(2, second)
    assert [tuple(r) for r in Rollup(spark, folder).totals().collect()] == [("a", "en", "v", 4, 1)]
    Rollup(spark, folder)._mark(2, False)
    opened = Rollup(spark, folder)
    assert opened.batches == {1} and [tuple(r) for r in opened.totals().collect()] == [("a", "en", "v", 15, 2)]
    opened.commit(2, second)
    with pytest.raises(ValueError, match="older"):
        Rollup(spark, folder).commit(1, second)
    assert [tuple(r) for r in Rollup(spark, folder).totals().collect()] == [("a", "en", "v", 4, 1)]


def test_token_rollup_counts_each_copy_in_order(spark):
    """Rows without id, rows of one id, and several changes of one document in a batch."""
    schema = "op string, doc_id long, digest long, source string, lang string, version string, tokens long, seq long"

    def change(*rows):
        return spark.createDataFrame([(op, i, d, "a", "en", "v", n, s) for op, i, d, n, s in rows], schema)

    def totals(rollup):
        return [tuple(r)[3:] for r in rollup.totals().collect()]

    rollup = Rollup(spark, f"{scratch_dir(spark)}/{uuid.uuid4().hex}")
    rollup.commit(1, change(*[("insert", None, k % 7, 4, 0) for k in range(10)], ("insert", 5, 1, 2, 0), ("insert", 5, 2, 4, 0)))
    assert totals(rollup) == [(46, 12)]
    rollup.commit(2, change(("revise", 5, 1, 10, 1), ("revise", 5, 1, 4, 2), ("insert", 6, 1, 9, 1), ("delete", 6, 1, 0, 2)))
    assert totals(rollup) == [(48, 12)]
    rollup.commit(3, change(("delete", 5, 2, 0, 1), ("insert", 5, 2, 7, 2), ("revise", None, 0, 1, 1), ("revise", 8, 1, 3, 1)))
    assert totals(rollup) == [(48 - 4 + 7 - 8 + 2 + 3, 13)]
    rollup.compact()
    opened = Rollup(spark, rollup.folder)
    assert opened.base == 3 and totals(opened) == [(48, 13)]
    for _ in range(2):
        opened.commit(4, change(("delete", None, 0, 0, 1), ("delete", 8, 1, 0, 1)))
    assert totals(opened) == [(48 - 2 - 3, 10)]
    with pytest.raises(ValueError, match="older"):
        opened.commit(3, change())


def test_word_counts_of_odd_rows(odd, none):
    got = {(r["doc_id"], r["tokens"]) for r in word_counts(odd).collect()}
    assert {(1, 60), (4, 0), (5, 0), (6, 0), (8, 2), (None, 2), (None, 0)} <= got and word_counts(none).count() == 0


def test_token_query(spark, texts):
    code, first = encoder(vocabulary()), {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    rows = queries.op9_token_counts(spark, SF).collect()
    assert sum(r["docs"] for r in rows) == len(first) and {r["version"] for r in rows} == {"byte_bpe_50k-1"}
    assert sum(r["tokens"] for r in rows) == sum(len(code.encode(t, allowed_special="all")) for t in first)


def test_languages(spark, documents):
    rows = queries.op10_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    found = {r["doc_id"]: r["lang"] for r in rows if r["doc_id"] is not None}
    assert set(found) == set(truth) and sum(found[i] == truth[i] for i in truth) >= 0.98 * len(truth)
    pages = table(spark, "/root/testdata/sf0.01", "pages").count()
    assert sum(r["page_id"] is not None for r in rows) == pages


def test_languages_of_odd_rows(spark, documents, none):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "http://h.example.org/x", ""), (None, "nonsense", "<html lang='de'>" + "x" * 100_000), (2, None, "<p>the</p>")],
        "page_id long, url string, html string",
    )
    rows = identified(page_evidence(pages), documents).collect()
    assert len(rows) == 4 and all(r["lang"] for r in rows)
    assert {r["lang"] for r in identified(page_evidence(pages), none).collect()} == {None, "de"}
    assert identified(page_evidence(pages.where("false")), documents).count() == 0


def test_items_without_id_are_found(spark):
    """A null item id is an id like any other; rows that hold an item go, each judged by itself."""
    item = " ".join(f"question{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"so {item} ends"), (None, item), (2, "clean"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (7, None), (8, "")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["distance"]) for r in contaminated(docs, items).collect()}
    assert found == {(1, None, 0), (None, None, 0)}
    assert sorted(r["doc_id"] for r in decontaminated(docs, items).collect()) == [2, 3]
    assert decontaminated(docs.where("false"), items).count() == 0 and decontaminated(docs, items.where("false")).count() == 4


def test_texts_with_and_without_long_tokens_are_masked_alike(spark):
    """Base spans go where the text lies; long tokens go if few owners have them."""
    key, common = "Zq8Lm2Xw9Rt5Yp3Kd7Ns1Vb", "Aa1Bb2Cc3Dd4Ee5Ff6Gg7Hh"
    rows = [(1, f"x password: abcdefghijkl y", "s1"), (2, f"live {key} and {common}", "s2")]
    rows += [(3 + i, f"see {common}", f"o{i}") for i in range(4)] + [(9, None, "s3"), (10, "", "s3")]
    docs = spark.createDataFrame([(i, t, "en", s) for i, t, s in rows], "doc_id long, text string, lang string, source string")
    out = {r["doc_id"]: r["text"] for r in redacted(docs).collect()}
    assert out[1] == "x [SECRET] y" and out[2] == f"live [SECRET] and {common}"
    assert all(out[3 + i] == f"see {common}" for i in range(4)) and out[9] is None and out[10] == ""


def test_kept_rows_come_back_whole(documents, odd, none):
    """The rows that pass are those whose verdict says so, with all their columns."""
    kept = {r["doc_id"] for r in quality(documents).where("kept").collect()}
    rows = passed(documents).collect()
    assert {r["doc_id"] for r in rows} == kept and rows[0].asDict().keys() == set(documents.columns)
    assert passed(odd).columns == odd.columns and passed(none).count() == 0


def test_partners_in_a_group_are_found_by_size(spark):
    """Fragments of one text that are linked with each other but not with the whole."""
    words = [f"w{i}" for i in range(200)]
    texts = {1: " ".join(words), 2: " ".join(words[:150]), 3: " ".join(words[:160]), 4: " ".join(words[20:170]), 5: " ".join(words[:155])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, width=4).collect()}
    assert found == linked(texts, 4)[1]


def test_marks_of_units_are_those_of_sentences():
    """The first pass, by numpy, finds the places that the second one does, and gives equal units equal hashes."""
    rng = random.Random(5)
    parts = ["a", "B", "b", " ", "\n", "\n\n", ".", "...", "?\n", "\t", "\u3000", "x y z", "X y  z.", "漢字", "İ", "i̇"]
    for least in (1, 2, 4) * 40:
        texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(6)]
        slow = [(i, u[0], u[4]) for i, t in enumerate(texts) for u in substring_dedup._sentences(t, least)]
        fast = list(zip(*(x.tolist() for x in substring_dedup._unit_marks(texts, least)), strict=True))
        groups = []
        for found in (slow, fast):
            equal = {}
            for row, place, value in found:
                equal.setdefault(value, []).append((row, place))
            groups.append(sorted(sorted(x) for x in equal.values()))
        assert groups[0] == groups[1]


def test_marks_of_units_fold_sigmas_and_empty_texts():
    own, place, h = substring_dedup._unit_marks(["", "Ο ΟΔΟΣ ο", "ο οδος ο.", "\n.\n"], 3)
    assert own.tolist() == [1, 2] and place.tolist() == [0, 0]
    assert substring_dedup._unit_marks(["Ο ΟΔΟΣ ο", "ο οδος ο"], 3)[2].tolist() == [h[0]] * 2
    assert [len(x) for x in substring_dedup._unit_marks(["", " \n"], 3)] == [0, 0, 0]


def test_near_duplicates_test_few_pairs_of_components(spark, monkeypatch):
    """Variants of one text: most pairs are settled by what they meet in, or once their components are one."""
    rng, texts = np.random.default_rng(8), {}
    for i in range(300):
        words = [f"w{k}" for k in range(300)]
        for at in rng.choice(300, 9 if i == 0 else rng.integers(1, 9), replace=False):
            words[at] = f"x{rng.integers(10**6)}"
        texts[i] = " ".join(words)
    tested, before = [], near_dedup.estimated

    def counted(pairs, nodes):
        tested.append(pairs.count())
        return before(pairs, nodes)

    monkeypatch.setattr(near_dedup, "estimated", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, 5).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(296)} for i, t in texts.items()}
    least = {i: i for i in texts}
    for a, b in itertools.combinations(texts, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((least[a], least[b]))
            least = {i: x if c == y else c for i, c in least.items()}
    assert found == least
    assert sum(tested) < 8500
