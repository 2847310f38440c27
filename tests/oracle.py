"""Compares registered queries with their SQL on DuckDB.

    python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = sorted((tuple(row[i] for i in order) for row in rows), key=repr)
    return [columns[i] for i in order], data


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    start = time.time()
    frame = contract.queries()[name](spark, folder)
    got = canonical(frame.columns, frame.collect())
    took = time.time() - start
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return bool(got[1]), f"{len(got[1])} rows, no SQL, {took:.2f} s"
    result = con.execute(sql)
    want = canonical([d[0] for d in result.description], result.fetchall())
    if got == want:
        return True, f"{len(got[1])} rows, {took:.2f} s"
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return False, f"{len(got[1])} rows, SQL has {len(want[1])}"
    pairs = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return False, f"{len(pairs)} rows differ, first {pairs[0]}"


def main() -> int:
    from rebasket.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = local_session("oracle", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(folder), 0
    for name in names:
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as problem:  # report and go on with the next query
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:1500]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
