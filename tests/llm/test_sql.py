"""Every training-data query that SQL can express, against DuckDB over the smallest tables."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")
pytest.importorskip("public_tokenizers")

from corpusloom.llm import queries, sql

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    made = queries.queries()[name](spark, DATA)
    columns = sorted(made.columns)
    result = con.execute(sql.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=str)
    assert sorted((tuple(row[c] for c in columns) for row in made.collect()), key=str) == want
