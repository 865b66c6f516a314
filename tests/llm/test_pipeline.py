"""The pipeline's stages, each on what its predecessor kept."""

import corpus_pipeline as pipeline
from tests.llm.conftest import SF
from tests.llm.test_operators import base_counts, base_spans, check_packing, linked, normal
from trailmeter.llm.common import stored, table


def test_stages(spark, documents):
    docs, kept = documents, {}
    for name, stage in pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stored(stage(spark, docs, SF))
        if name != "packing":
            assert docs.columns == pipeline.COLUMNS
        kept[name] = rows = {r["doc_id"]: r for r in docs.collect()}
        if name == "quality_rules":
            failed = {i for i, t in before.items() if (c := base_counts(t))[0] < 20 or 100 * c[4] > 30 * c[0]}
            assert not failed & set(rows) and len(rows) > 0.6 * len(before)
        elif name == "near_dedup":
            assert set(rows) == {i for i, c in linked(before, 5)[1].items() if i == c}
        elif name == "decontamination":
            items = [normal(r["text"]) for r in table(spark, SF, "benchmark").collect()]
            held = {i for i, t in before.items() if any(x in normal(t) for x in items)}
            assert held and set(rows) == set(before) - held
        elif name == "secret_scan":
            assert set(rows) == set(before) and any(base_spans(t)[1] for t in before.values())
            assert not any(base_spans(r["text"])[1] for r in rows.values())
            assert all(r["text"] == before[i] for i, r in rows.items() if not base_spans(before[i])[1])
        else:
            check_packing(docs.collect(), before)


def test_odd_rows(spark, odd, none):
    for start in (odd, none):
        docs = start
        for _, stage in pipeline.STAGES:
            docs = stored(stage(spark, docs, SF))
        assert docs.count() == 0 or start is odd


def test_rows_without_or_of_one_id_are_judged_by_themselves(spark, documents):
    item = table(spark, SF, "benchmark").first()["text"]
    one, two = (" ".join(f"{w}{i}" for i in range(60)) for w in ("east", "west"))
    rows = [(None, one), (None, one), (None, f"so {item} it is"), (None, None), (3, two), (3, two), (3, f"so {item} it is"), (None, two)]
    docs = spark.createDataFrame([(i, t, "en", "a", 9) for i, t in rows], documents.schema)
    found = [(r["doc_id"], r["text"]) for r in pipeline.near_dedup(spark, docs, SF).where("text like '%59'").collect()]
    assert sorted(found, key=str) == [(3, two), (None, one)]
    found = [(r["doc_id"], r["text"]) for r in pipeline.decontamination(spark, docs, SF).collect()]
    assert sorted(found, key=str) == sorted([rows[i] for i in (0, 1, 3, 4, 5, 7)], key=str)
    texts = [r["text"] for r in pipeline.quality_rules(spark, docs, SF).collect()]
    assert None not in texts and texts.count(one) == 2 and texts.count(two) == 3


def test_run(spark):
    assert pipeline.run(spark, SF).count() > 0
