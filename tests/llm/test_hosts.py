import duckdb
import pytest

from factweave.llm import hosts as H
from factweave.llm import queries as Q

URLS = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.com", "http://example.com/", "https://a.EXAMPLE.com/en/x?y#z", "https://www.example.com/en/", "http://xexample.com/en/1", "http://x.net/fr/?", "http://net/es/1", "http://x.net/es", "http://İ.net/fr/", "a://b.co.uk:80/p#q", "x://u@h.org?x=/y", "x://é.example.org/a://b", "http://m.bad.example.org/1", "http://bad.example.org/2\nx"]


@pytest.fixture
def tables(spark, tmp_path):
    n = 400
    spark.createDataFrame([(k, URLS[k % len(URLS)], "<p>", "c") for k in range(n)] + [(None, URLS[-1], "", "c")], "page_id long, url string, html string, host string").write.parquet(str(tmp_path / "pages.parquet"))
    rows = [(k, None if k % 11 == 0 else int("bad." not in (URLS[k % len(URLS)] or "") or k % 7 == 0), 0) for k in range(0, n, 2)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_same_as_sql(spark, tables):
    got = sorted(map(str, Q.op9_hosts(spark, tables).collect()))
    c = duckdb.connect()
    for t in ("pages", "labels"):
        c.execute(f"create view {t} as select * from '{tables}/{t}.parquet/*.parquet'")
    cur = c.execute(Q.ORACLES["op9_hosts"])
    names = [d[0] for d in cur.description]
    from pyspark.sql import Row

    want = sorted(str(Row(**dict(zip(names, r, strict=True)))) for r in cur.fetchall())
    assert got == want
    assert {r.verdict for r in Q.op9_hosts(spark, tables).where("host like '%bad.example.org'").collect()} == {"block"}


def test_longest_rule_and_parts(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    h, p = H.host_and_path(df.url)
    n, v = H.by_rule(h, p, Q.URL_RULES)
    got = {r.url: (r.h, r.p, r.n, r.v) for r in df.select("url", h.alias("h"), p.alias("p"), n.alias("n"), v.alias("v")).collect()}
    assert got["https://www.example.com/en/"] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got["https://a.EXAMPLE.com/en/x?y#z"] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got["http://xexample.com/en/1"][2:] == ("com/", "allow")
    assert got["HTTP://EXAMPLE.com"] == ("example.com", "", None, None)
    assert got["http://net/es/1"][2:] == ("net/es/", "block") and got["http://x.net/es"][2] is None
    assert got[None][:2] == got["no scheme"][:2] == ("", "") and got["x://u@h.org?x=/y"][:2] == ("u@h.org", "")
    assert got["http://İ.net/fr/"][0] == "İ.net" and got["a://b.co.uk:80/p#q"][:2] == ("b.co.uk:80", "/p")


def test_no_rows_and_no_outcomes(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    assert [r.verdict for r in H.judge(pages, none, []).collect()] == ["allow"]
    assert H.judge(pages.limit(0), none, Q.URL_RULES).count() == 0
