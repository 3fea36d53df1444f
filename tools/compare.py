"""Run registered queries on Spark and their SQL counterparts on DuckDB and compare the rows.

usage: python tools/compare.py [--sf sf0.01] [id ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def compare(spark, con, query, folder: str) -> str:
    """Empty if equal, otherwise what differs."""
    df = query.run(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if query.oracle is None:
        return "" if rows else "no rows"
    result = con.execute(query.oracle)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if names != df.columns:
        return f"columns {df.columns} != {names}"
    rows.sort(key=lambda r: tuple(map(repr, r)))
    expected.sort(key=lambda r: tuple(map(repr, r)))
    if rows != expected:
        extra = [r for r in rows if r not in set(expected)][:3]
        missing = [r for r in expected if r not in set(rows)][:3]
        return f"{len(rows)} rows != {len(expected)}; only Spark {extra}; only SQL {missing}"
    return "" if rows else "no rows on both sides"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="sf0.01")
    parser.add_argument("ids", nargs="*")
    args = parser.parse_args()
    from starloom.catalog import load_queries
    from starloom.session import local_session

    folder = f"/root/testdata/{args.sf}"
    spark, con = local_session(8), duck(folder)
    bad = 0
    for name, query in load_queries().items():
        if args.ids and not any(name.startswith(i) for i in args.ids):
            continue
        started = time.monotonic()
        try:
            problem = compare(spark, con, query, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.monotonic() - started:.2f}s {problem}", flush=True)
    print(f"{bad} differences")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
