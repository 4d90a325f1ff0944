"""Run registered queries beside their SQL: ``python -m checks.compare [sf folder] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks import documents, increments, operators  # noqa: F401  (they fill the registry)
from checks.registry import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def rows_of(records, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in records)


def check(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    """An empty text when both sides agree, else what differs."""
    df = QUERIES[name](spark, folder)
    got = rows_of(df.collect(), df.columns)
    if name not in ORACLES:
        return "" if got else "no rows"
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = rows_of(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if got != want:
        first = next(((g, w) for g, w in zip(got, want, strict=False) if g != w), None)
        return f"{len(got)} against {len(want)} rows; first difference {first}"
    return "" if got else "no rows on either side"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = check(spark, con, folder, name)
        except Exception as e:  # a broken query must not hide the others' results
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
