import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trailmeter.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "2",
            # Compiling plans takes far longer than running them on a few rows.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module")
def fixed_plans(spark):
    """Run a module without adaptive planning, for many small queries."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="module")
def compiled_plans(spark):
    """Run a module as a cluster would: adaptive planning and compiled plans."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")


@pytest.fixture
def make(spark):
    """Build a frame from dicts; columns left out of a row are NULL."""

    def build(rows, schema):
        names = schema.names if hasattr(schema, "names") else None
        if names is None:
            names = [part.split()[0] for part in schema.split(",")]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return build


@pytest.fixture
def rows_of():
    """Rows as sorted tuples of the named columns (all of them by default)."""

    def collect(df, *names):
        found = [tuple(row) for row in df.select(*(names or sorted(df.columns))).collect()]
        return sorted(found, key=lambda row: tuple((v is not None, str(v)) for v in row))

    return collect
