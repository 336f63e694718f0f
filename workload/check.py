"""Compare queries with their SQL: ``python -m workload.check SF_DIR [NAME ...]``."""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from workload.oracle import ORACLE
from workload.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _rows(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows in a fixed order."""
    frame = frame[sorted(frame.columns)].astype("string").fillna("<null>")
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(spark_result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both results hold the same rows, else what differs."""
    expected = con.sql(sql).to_arrow_table()
    expected = _rows(expected.to_pandas(types_mapper=pd.ArrowDtype))
    got = _rows(spark_result.toArrow().to_pandas(types_mapper=pd.ArrowDtype))
    if list(got.columns) != list(expected.columns):
        return f"columns {list(got.columns)} != {list(expected.columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    if not got.equals(expected):
        unequal = (got != expected).any(axis=1)
        return f"{unequal.sum()} rows differ, e.g. {got[unequal].head(3)} {expected[unequal].head(3)}"
    return ""


def main(sf_dir: str, *names: str) -> int:
    shared = tempfile.mkdtemp(prefix="check-")
    spark = SparkSession.builder.config("spark.checkpoint.dir", shared).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        begin = time.time()
        try:
            message = difference(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as error:  # noqa: BLE001
            message = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(message)
        print(f"{name:24} {time.time() - begin:6.1f}s {message or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
