"""Every query with SQL against DuckDB over the smallest tables."""

import glob
import os

import pytest

from corpusloom.plans import oracle, queries

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_same_rows(spark, tables, name):
    made = queries.queries()[name](spark, DATA)
    columns = sorted(made.columns)
    result = tables.execute(oracle.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=str)
    assert sorted((tuple(row[c] for c in columns) for row in made.collect()), key=str) == want


def test_rest_have_rows(spark):
    for name in set(queries.queries()) - set(oracle.SQL):
        assert queries.queries()[name](spark, DATA).count() > 0
