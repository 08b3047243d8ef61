"""Titles that are cut inside a reference, against the queries' SQL."""

import pytest

from corpusloom.plans import oracle, queries

duckdb = pytest.importorskip("duckdb")
CUT = ["&quot", "&quo", "&copy", "&middot", "&amp", "&am", "&", "&quot;", "&amp;quot;"]


@pytest.mark.parametrize("name", ["body_text", "minimum_slice", "parse_article"])
def test_as_in_sql(spark, tmp_path, name):
    html = "<html><head><title>Token = {0}</title></head><body><nav>N</nav><article><h1>Token = {0}</h1><p><b>Token = &quot;ab&quot; &amp; {1}<br></article></body></html>"
    rows = [(i, f"https://a.example.org/en/{i}.html", html.format(c, "words " * 80)) for i, c in enumerate(CUT)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    result = con.execute(oracle.SQL[name])
    columns = [d[0] for d in result.description]
    want = sorted(result.fetchall())
    assert len(want) == len(CUT)
    assert sorted(tuple(r[c] for c in columns) for r in queries.queries()[name](spark, str(tmp_path)).collect()) == want
