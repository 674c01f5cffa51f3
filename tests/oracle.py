"""Run registered queries against their SQL on DuckDB.

    python -m tests.oracle [--sf /root/testdata/sf0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is None else "", str(v)) for v in row)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names = sorted(spark_df.columns)
    got = [tuple(_norm(r[n]) for n in names) for r in spark_df.collect()]
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    rows = cur.fetchall()
    if sorted(cols) != names:
        return f"columns: spark {names} sql {sorted(cols)}"
    order = [cols.index(n) for n in names]
    want = [tuple(_norm(r[i]) for i in order) for r in rows]
    if len(got) != len(want):
        return f"rows: spark {len(got)} sql {len(want)}"
    kinds = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    same = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    odd = [f"{n}: {kinds[n]}/{types[n]}" for n in names if same.get(kinds[n]) != types[n]]
    a, b = sorted(got, key=_key), sorted(want, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return f"values: {dict(zip(names, x))} != {dict(zip(names, y))}" + (f" types {odd}" if odd else "")
    return f"types: {odd}" if odd else None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from tests.session import make_session

    import __spark_entry__ as entry

    spark = make_session()
    con = connect(args.sf)
    sql = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        started = time.time()
        try:
            df = build(spark, args.sf)
            problem = compare(df, con, sql[name]) if name in sql else None
            note = f"{df.count()} rows" + ("" if name in sql else " (no SQL)")
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {note} {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
