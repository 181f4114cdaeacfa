"""Run queries and their DuckDB SQL side by side.

    python tests/compare.py [data folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(r[i] for i in order) for r in rows)


def mismatch(df, con, sql: str) -> str | None:
    """None where both hold the same rows; otherwise what differs."""
    columns, got = _bag(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names, want = _bag([d[0] for d in cur.description], cur.fetchall())
    if columns != names:
        return f"columns {columns} != {names}"
    if got != want:
        return (f"{sum(got.values())} rows != {sum(want.values())}; "
                f"only Spark {list((got - want).items())[:2]}; only SQL {list((want - got).items())[:2]}")
    return None if got else "no rows on either side"


def main() -> int:
    from tests.session import make_session
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), oracle_connection(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = mismatch(queries[name](spark, folder), con, oracles[name])
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if problem is None else problem[:900]}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
