"""Run registered queries beside their SQL in DuckDB and report every difference.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


def differences(spark, con, folder, query, sql) -> str | None:
    df = query(spark, folder)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got = [tuple(r) for r in df.collect()]
    a, b = _sorted(df.columns, got), _sorted(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; first {a[:2]} {b[:2]}"
    for x, y in zip(a, b):
        if x != y:
            return f"{sum(p != q for p, q in zip(a, b))} of {len(a)} rows differ, first\n  {x}\n  {y}"
    return None


def main() -> int:
    from modelvigil.plans import registry
    from modelvigil.session import local_session

    folder, names = sys.argv[1], sys.argv[2:] or list(registry.QUERIES)
    spark, con = local_session(), connect(folder)
    failed = 0
    for name in names:
        started = time.time()
        if name not in registry.ORACLES:
            print(f"rows {name}: {registry.QUERIES[name](spark, folder).count()} {time.time() - started:.1f}s", flush=True)
            continue
        try:
            problem = differences(spark, con, folder, registry.QUERIES[name], registry.ORACLES[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'DIFF' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
