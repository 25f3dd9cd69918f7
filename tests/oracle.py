"""Compare named queries with their SQL counterparts."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v) if abs(v) < 2**53 else v
    return v


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def difference(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else a short description."""
    df = fn(spark, sf_dir)
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    off = {n: (t, kinds[n]) for n, t in df.dtypes if TYPES.get(t, t) != kinds[n] and kinds[n] != '"NULL"'}
    a, b = _rows(got, df.columns), _rows(want, names)
    if len(a) != len(b):
        only = sorted(set(a) - set(b), key=str)[:2], sorted(set(b) - set(a), key=str)[:2]
        return f"rows {len(a)} vs {len(b)}: {only}"
    for x, y in zip(a, b):
        if x != y:
            only = sorted(set(a) - set(b), key=str)[:2], sorted(set(b) - set(a), key=str)[:2]
            return f"values {sorted(names)}: {only}"
    if off:
        return f"types {off}"
    return None


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from bibweave.session import local_session

    QUERIES, ORACLES = queries(), oracle_sql()
    sf_dir = sys.argv[1]
    picks = sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if picks and not any(name.startswith(p) for p in picks):
            continue
        t0 = time.time()
        try:
            if name in ORACLES:
                msg = difference(spark, con, fn, ORACLES[name], sf_dir)
                n = con.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchone()[0]
            else:
                msg, n = None, fn(spark, sf_dir).count()
        except Exception as e:  # report and go on
            msg, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += msg is not None
        print(f"{'ok  ' if msg is None else 'FAIL'} {name} rows={n} {time.time() - t0:.1f}s {msg or ''}"[:1400], flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
