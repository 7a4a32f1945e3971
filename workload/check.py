"""Run registered queries in Spark and DuckDB side by side and compare them value by value."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from collections import Counter
from collections.abc import Iterable
from typing import Any

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value: Any) -> Any:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int | float):
        return round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns: list[str], rows: Iterable[Iterable[Any]]) -> Counter[tuple[Any, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in map(tuple, rows))


def compare(spark: SparkSession, sf: str, name: str, con: duckdb.DuckDBPyConnection) -> str:
    """'ok', 'rows only' or a description of the first differences."""
    from workload.oracle import ORACLE
    from workload.queries import QUERIES

    frame = QUERIES[name](spark, sf)
    left = rows_of(frame.columns, frame.collect())
    if name not in ORACLE:
        return f"rows only ({sum(left.values())})"
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns differ: {sorted(set(columns) ^ set(frame.columns))}"
    right = rows_of(columns, result.fetchall())
    if left == right:
        return f"ok ({sum(left.values())})"
    only_left, only_right = list((left - right).items()), list((right - left).items())
    return (
        f"DIFFERENT {sum(left.values())} vs {sum(right.values())}\n"
        f"   {sorted(columns)}\n   spark only {len(only_left)}: {only_left[:2]}\n"
        f"   duck only  {len(only_right)}: {only_right[:2]}"
    )


def main() -> None:
    from workload.queries import QUERIES

    sf = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
    names = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in names:
        started = time.time()
        try:
            verdict = compare(spark, sf, name, con)
        except Exception as error:  # one broken query must not hide the others
            verdict = f"ERROR {type(error).__name__}: {str(error)[:900]}"
        print(f"{name:36s} {time.time() - started:6.2f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
