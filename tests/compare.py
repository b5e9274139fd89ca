"""Compare registered queries with their SQL: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from claimworks.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or isinstance(v, (bool, int, float, str)):
        return v
    return str(v)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


#: Plan nodes no query may have: all pairs of rows, and Python in the row path.
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas")


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal; else what differs first."""
    df = contract.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if any(node in plan for node in BANNED):
        return f"plan has one of {BANNED}"
    mine = df.collect()
    got = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in got.description]
    theirs = got.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    a, b = sorted_rows(df.columns, mine), sorted_rows(names, theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0][0]} / {wrong[0][1]}"
    for x, y in zip(a[:50], b[:50]):
        if [type(v) for v in x] != [type(v) for v in y]:
            return f"types {[type(v).__name__ for v in x]} / {[type(v).__name__ for v in y]}"
    return None


def main() -> int:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    chosen = sys.argv[2:] or list(contract.queries())
    spark, con, failed = local_session(), connect(sf_dir), 0
    for name in chosen:
        start = time.time()
        if name not in contract.oracle_sql():
            rows = contract.queries()[name](spark, sf_dir).count()
            print(f"{name:32} rows only {rows} {time.time() - start:.1f}s", flush=True)
            continue
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32} {problem or 'same'} {time.time() - start:.1f}s", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} same or rows only")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
