"""Run registered queries against their SQL in DuckDB and compare whole results.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def compare(spark, con, folder, fn, sql):
    """Error text, or None if equal; with row count and both run times."""
    t0 = time.time()
    df = fn(spark, folder)
    got_rows = df.collect()
    t1 = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    t2 = time.time()
    gc, got = rows_of(df.columns, [tuple(r) for r in got_rows])
    wc, want = rows_of(names, want_rows)
    error = None
    if gc != wc:
        error = f"columns {gc} != {wc}"
    elif got != want:
        error = f"{len(got_rows)} vs {len(want_rows)} rows; only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
    else:
        kinds = {c: t for c, t in df.dtypes}
        sql_kinds = dict(con.execute(f"select column_name, column_type from (describe {sql})").fetchall())
        same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
        odd = {c: (k, sql_kinds[c]) for c, k in kinds.items() if same.get(k) != sql_kinds[c]}
        error = f"types {odd}" if odd else None
    return error, len(got_rows), t1 - t0, t2 - t1


if __name__ == "__main__":
    import __spark_entry__ as entry
    from conftest import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark, con = session(), connect(folder)
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in names:
        try:
            error, n, a, b = compare(spark, con, folder, entry.queries()[name], entry.oracle_sql()[name])
        except Exception as e:
            error, n, a, b = f"{type(e).__name__}: {str(e)[:700]}", -1, 0, 0
        bad += error is not None
        print(f"{'ok  ' if error is None else 'BAD '} {name:28s} rows={n} spark={a:.1f}s sql={b:.1f}s {error or ''}"[:1500], flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
