"""Brute-force twins shared by the operator and pipeline tests."""
import duckdb

from tabprism.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"


def duck_rows(sql, sf_dir=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{table_path(sf_dir, t)}'")
    rel = con.sql(sql)
    return sorted((dict(zip(rel.columns, r)) for r in rel.fetchall()), key=lambda r: repr(sorted(r.items())))


def spark_rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: repr(sorted(r.items())))


def brute_lines(rows, min_chars=40, min_docs=5):
    """(id, kept lines, n lines, n dropped) of (id, text) rows."""
    low = {c: c + 32 for c in range(65, 91)}
    split = [(d, (t or "").split("\n")) for d, t in rows]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(low)
    holders = {}
    for d, lines in split:
        for k in {key(x) for x in lines if len(key(x)) >= min_chars}:
            holders.setdefault(k, []).append(d)
    out = []
    for d, lines in split:
        kept = []
        for x in lines:
            ids = holders.get(key(x), [])
            known = [i for i in ids if i is not None]
            if len(ids) < min_docs or not known or d == max(known):
                kept.append(x)
        out.append((d, kept, len(lines), len(lines) - len(kept)))
    return out
