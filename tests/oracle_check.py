"""Compares registered queries with their SQL: ``python tests/oracle_check.py [sf] [name part ...]``."""

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
SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def differences(spark, con, name, fn, sql, sf_dir) -> list[str]:
    """Empty when schema and rows agree."""
    df = fn(spark, sf_dir)
    got_types = {c: SPARK_TYPES.get(t, t) for c, t in df.dtypes}
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want_types = {d[0]: str(d[1]) for d in found.description}
    want = rows_of(names, found.fetchall())
    out = []
    if got_types != want_types:
        out.append(f"types {sorted(set(got_types.items()) ^ set(want_types.items()))}")
    if got != want:
        out.append(f"rows {sum(got.values())} / {sum(want.values())}, "
                   f"only spark {list((got - want).items())[:3]}, only sql {list((want - got).items())[:3]}")
    return out


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from offerforge.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name, fn in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = differences(spark, con, name, fn, oracles[name], sf_dir)
            else:
                problems = [] if fn(spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # the report names every query that fails
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '}{name} {time.time() - start:.2f}s{'' if name in oracles else ' (rows)'}")
        for p in problems:
            print("    ", p)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
