"""Compare registered queries with their SQL twins: python -m harness.check [keys]."""

from __future__ import annotations

import math
import os
import sys
import time
from collections.abc import Iterable
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from harness.oracles import ORACLES
from harness.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("maillage-check")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # no call-site capture for every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: object) -> object:
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def _rows(columns: list[str], rows: Iterable[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, key: str, sf_dir: str) -> str:
    """Empty when both agree exactly, else what differs."""
    df = QUERIES[key](spark, sf_dir)
    got = _rows(df.columns, map(tuple, df.collect()))
    result = con.execute(ORACLES[key])
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        extra, lacking = set(got) - set(want), set(want) - set(got)
        return (
            f"rows {len(got)} vs {len(want)}; only here {sorted(extra)[:3]}; "
            f"only in SQL {sorted(lacking)[:3]}"
        )
    return ""


def main() -> int:
    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark, con = session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    keys = sys.argv[1:] or list(QUERIES)
    failed = 0
    for key in keys:
        start = time.time()
        try:
            problem = compare(spark, con, key, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - start:.1f}s {problem}")
    print(f"{len(keys) - failed} of {len(keys)} agree; without SQL: {set(QUERIES) - set(ORACLES)}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
