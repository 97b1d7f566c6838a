"""Compare a registered query with its check SQL, as multisets of rows."""

from __future__ import annotations

import glob
import os
import time

import duckdb

DATA = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def oracle_connection(sf_dir: str = DATA):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return ("f", repr(value + 0.0))
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    if isinstance(value, bool):
        return ("b", str(value))
    return (type(value).__name__[0], str(value))


def differences(spark, con, fn, sql: str, sf_dir: str = DATA) -> list[str]:
    start = time.time()
    df = fn(spark, sf_dir)
    names = df.columns
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    rel = con.execute(sql)
    want_names = [d[0] for d in rel.description]
    want = rel.fetchall()
    problems = []
    if sorted(names) != sorted(want_names):
        return [f"columns differ: spark only {set(names) - set(want_names)}, sql only {set(want_names) - set(names)}"]
    order = sorted(names)
    a = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in got)
    b = sorted(tuple(plain(r[want_names.index(c)]) for c in order) for r in want)
    if len(a) != len(b):
        problems.append(f"rows: spark {len(a)}, sql {len(b)}")
    if not got:
        problems.append("no rows at all")
    if a != b:
        from collections import Counter

        ca, cb = Counter(a), Counter(b)
        only_a, only_b = list((ca - cb).elements()), list((cb - ca).elements())
        problems.append(f"{len(only_a)} / {len(only_b)} rows differ")
        if only_a and only_b:
            problems.append("first: " + "; ".join(
                f"{c}: {x[1] if isinstance(x, tuple) else x} | {y[1] if isinstance(y, tuple) else y}"
                for c, x, y in zip(order, only_a[0], only_b[0]) if x != y))
        elif only_a or only_b:
            problems.append(f"spark only {only_a[:1]} sql only {only_b[:1]}")
    del took
    return problems
