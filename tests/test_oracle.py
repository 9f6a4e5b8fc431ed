"""Every registered query with an oracle equals its DuckDB twin on sf0.001;
every rows-only query runs."""

import math

import pytest

from tests.conftest import SF_SMALL
from tabprism.plans.registry import entries

_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, repr(v))
    return (3, repr(v))


ORACLE = sorted(k for k, e in entries().items() if e.oracle)
ROWS = sorted(k for k, e in entries().items() if not e.oracle)


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_oracle(spark, duck, name):
    e = entries()[name]
    sdf = e.build(spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = duck.execute(e.oracle)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    duck.execute(f"CREATE OR REPLACE TEMP VIEW _q AS {e.oracle}")
    d_types = {r[0]: r[1] for r in duck.execute("DESCRIBE _q").fetchall()}
    for f in sdf.schema.fields:
        t = f.dataType.simpleString()
        assert _TYPE_MAP.get(t, t) == d_types[f.name], f.name
    order = [d_cols.index(c) for c in sdf.columns]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    assert sorted(tuple(map(_norm, r)) for r in s_rows) == sorted(tuple(map(_norm, r)) for r in d_rows)


@pytest.mark.parametrize("name", ROWS)
def test_rows_only_query_runs(spark, name):
    df = entries()[name].build(spark, SF_SMALL)
    assert df.count() > 0
    assert len(df.columns) > 0


def test_entry_smoke(spark):
    import __spark_entry__ as se
    df = se.entry(spark)
    assert df.count() == 8
    assert set(se.oracle_sql()) <= set(se.queries())
