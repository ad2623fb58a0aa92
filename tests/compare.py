"""Side-by-side run of queries and oracles: ``python -m tests.compare [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("orders", "customer", "lineitem", "part", "documents", "pages", "benchmark", "labels")


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if not Path(folder, f"{t}.parquet").exists():
            continue  # folders of tests hold the tables they need
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "\x00null"  # not the mark of any text, the empty one included
    if isinstance(v, float) and math.isnan(v):
        return "\x00nan"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}" if abs(v) < 1 else f"{v:.15g}"
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str:
    """Empty when both sides are equal, else what differs first."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    a, b = rows_of(df.columns, df.collect()), rows_of(names, theirs.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows <> {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(names)}\n  {x}\n  {y}"
    return ""


def main(folder: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    queries, oracles = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or [name for name in queries if name in oracles]:
        start = time.time()
        diff = compare(queries[name](spark, folder), con, oracles[name])
        bad += bool(diff)
        print(f"{'DIFF' if diff else 'ok  '} {name} {time.time() - start:.2f}s {diff}", flush=True)
    print(f"{bad} differ; without an oracle: {sorted(set(queries) - set(oracles))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
