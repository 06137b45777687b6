"""Every registered query that has SQL runs on Spark and on DuckDB; results
must agree (rows, column names and types, values up to 1e-6)."""

import math

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E

SQL = E.oracle_sql()
TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(records, cols):
    rows = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    con = duck(SF_SMALL)
    sdf = E.queries()[name](spark, SF_SMALL)
    srecs = [r.asDict() for r in sdf.collect()]
    rel = con.sql(SQL[name])
    drecs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(rel.columns)
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for c, t in sdf.dtypes:
        assert TYPE_MAP.get(t, t) == dtypes[c], (c, t, dtypes[c])
    cols = sorted(sdf.columns)
    assert _rows(srecs, cols) == _rows(drecs, cols)


def test_every_query_has_a_builder():
    assert set(SQL) <= set(E.queries())


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "overall_revenue_rank" in df.columns
