"""Every registered query next to its expected result on the smallest tables."""

import os

import pytest

from harness import queries
from harness.compare import difference
from harness.oracle import ORACLE

pytestmark = pytest.mark.usefixtures("compiled_plans")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module", autouse=True)
def detail_stored_once():
    """Several queries store the same detail first; here they share it."""
    build, stored = queries.stored_detail, {}

    def shared(spark, sf_dir, *versions):
        if versions not in stored:
            stored[versions] = build(spark, sf_dir, *versions)
        return stored[versions]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "stored_detail", shared)
        yield


def test_every_query_has_an_expected_result():
    assert set(ORACLE) == set(queries.QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), SF_DIR, ORACLE[name]) is None
