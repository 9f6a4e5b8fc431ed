"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [--sql-only] [sf_dir] [name ...]

Compares column names, mapped types, row counts and the order-insensitive multiset
of rows (exact values, after the query's own rounding).
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tabprism.plans.registry import entries  # noqa: E402
from tabprism.session import local_session  # noqa: E402
from tabprism.sources.tables import TABLES, table_path  # noqa: E402

_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT",
             "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _spark_type(t: str) -> str:
    if t.startswith("array<"):
        return _spark_type(t[6:-1]) + "[]"
    return _TYPE_MAP.get(t, t)


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(v))
    if isinstance(v, (list, tuple)):
        return (3, repr([_norm(x) for x in v]))
    return (4, repr(v))


def compare(spark, con, e, sf_dir):
    t0 = time.time()
    sdf = e.build(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_cols = sdf.columns
    s_types = [_spark_type(f.dataType.simpleString()) for f in sdf.schema.fields]
    rel = con.execute(e.oracle)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
        return problems, t1 - t0, len(s_rows), len(d_rows)
    con.execute(f"CREATE OR REPLACE TEMP VIEW _q AS {e.oracle}")
    desc = con.execute("DESCRIBE _q").fetchall()
    d_type_by = {r[0]: r[1] for r in desc}
    for c, st in zip(s_cols, s_types):
        if d_type_by.get(c) != st:
            problems.append(f"type {c}: spark={st} duck={d_type_by.get(c)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    sk = sorted(tuple(_norm(v) for v in r) for r in s_rows)
    dk = sorted(tuple(_norm(v) for v in r) for r in d_rows)
    if sk != dk:
        diff = [(a, b) for a, b in zip(sk, dk) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, t1 - t0, len(s_rows), len(d_rows)


def main():
    args = sys.argv[1:]
    sql_only = "--sql-only" in args
    args = [a for a in args if a != "--sql-only"]
    sf_dir = "/root/testdata/sf0.01"
    if args and os.path.isdir(args[0]):
        sf_dir, args = args[0], args[1:]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    ok = bad = 0
    for name, e in entries().items():
        if args and name not in args:
            continue
        if not e.oracle:
            if sql_only:
                continue
            try:
                t0 = time.time()
                n = e.build(spark, sf_dir).count()
                print(f"ROWS  {name:32s} {n} rows {time.time() - t0:.1f}s")
            except Exception:
                bad += 1
                print(f"FAIL  {name}: {traceback.format_exc(limit=3)}")
            continue
        try:
            problems, secs, ns, nd = compare(spark, con, e, sf_dir)
        except Exception:
            problems, secs, ns, nd = [traceback.format_exc(limit=4)], 0, 0, 0
        if problems:
            bad += 1
            print(f"FAIL  {name:32s} {ns}/{nd} rows {secs:.1f}s")
            for p in problems:
                print("      ", p[:1500])
        else:
            ok += 1
            print(f"OK    {name:32s} {ns} rows {secs:.1f}s")
    print(f"{ok} ok, {bad} failing")


if __name__ == "__main__":
    main()
