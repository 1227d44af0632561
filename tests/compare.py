"""Row-by-row comparison of a Spark query with its SQL twin in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=lambda r: [(v is not None, str(v)) for v in r])


def differences(df, con, sql) -> list[str]:
    """What differs, in words; an empty list if nothing does."""
    names, ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    other_names, theirs = _rows([d[0] for d in found.description], found.fetchall())
    if names != other_names:
        return [f"columns {names} against {other_names}"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    return [f"{a} against {b}" for a, b in zip(ours, theirs) if a != b]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    folder, *wanted = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(folder), contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in oracle:
                bad = differences(df, con, oracle[name])
                state = "ok" if not bad else f"DIFFERENT ({len(bad)}) {bad[:3]}"
            else:
                state = f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001 - reported, the others still run
            state = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:26s} {time.time() - start:6.2f}s {state}", flush=True)
