"""Run queries next to their expected results: ``python -m harness.compare SF_DIR [names...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from harness.oracle import ORACLE
from harness.queries import QUERIES
from trailmeter.session import build_session


def expected(sf_dir: str, sql: str) -> pd.DataFrame:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection.execute(sql).fetchdf()


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    cleaned = [
        ["\0" if pd.isna(v) else f"{v:.6f}" if isinstance(v, float) else str(v) for v in frame[c]]
        for c in frame.columns
    ]
    return sorted(zip(*cleaned)) if cleaned else []


def difference(actual: DataFrame, sf_dir: str, sql: str) -> str | None:
    """None if columns, row count and all values agree; else what differs."""
    want, got = expected(sf_dir, sql), actual.toPandas()
    if sorted(want.columns) != sorted(got.columns):
        return f"columns {sorted(set(want.columns) ^ set(got.columns))}"
    for frame, other in ((want, got), (got, want)):
        for name in frame.columns:
            # Integers with NULLs come as floats on one side only.
            if pd.api.types.is_numeric_dtype(frame[name]) and not pd.api.types.is_bool_dtype(
                frame[name]
            ):
                frame[name] = frame[name].astype(float)
                other[name] = other[name].astype(float)
    a, b = _rows(want), _rows(got)
    if a == b:
        return None
    only_want, only_got = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return (
        f"rows {len(a)} expected, {len(b)} found; {len(only_want)} missing, {len(only_got)} extra; "
        f"{sorted(want.columns)} missing {only_want[:2]} extra {only_got[:2]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark: SparkSession = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names or list(QUERIES):
        begin = time.time()
        found = difference(QUERIES[name](spark, sf_dir), sf_dir, ORACLE[name])
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - begin:.1f}s", flush=True)
        if found:
            print("    ", found, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
