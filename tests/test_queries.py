"""Every registered query with SQL gives the same rows as DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from areapanel.plans import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float):
        return round(x, 5) + 0.0
    return x if isinstance(x, (bool, str)) else int(x) if hasattr(x, "__int__") and not hasattr(x, "year") else str(x)


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(cell(r[i]) for i in order) for r in values), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(name, spark, duck):
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    got, expected = rows(df.columns, [tuple(r) for r in df.collect()]), rows(want.columns, want.fetchall())
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        assert all(x == y or (isinstance(x, float) and y is not None and abs(x - y) <= 2e-5) for x, y in zip(a, b, strict=True)), (a, b)
