"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(clean(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF)
    result = con.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    got, want = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(names, want)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b, rel=1e-9, abs=2e-6) if _numeric(a) else a == b


def _numeric(row):
    return any(isinstance(v, float) for v in row) and all(isinstance(v, (int, float)) for v in row)


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0
