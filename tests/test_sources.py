import json

import pytest
from pyspark.sql import functions as F

from factweave.functions import contact_values as V
from factweave.functions import text as T
from factweave.operators import contacts as C
from factweave.operators import routing, rules
from factweave.sources import readers as R
from factweave.sources import writers as W
from factweave.streaming import ops

SF = "/root/testdata/sf0.001"


def test_lists(spark, tmp_path):
    (tmp_path / "u.txt").write_text("# no\n\n https://A.example/x \nb.example\nplain\n")
    assert [r.url for r in R.url_lines(spark, str(tmp_path / "u.txt")).orderBy("line").collect()] == ["https://A.example/x", "https://b.example", "plain"]
    (tmp_path / "e.csv").write_text('name,mail\nx,"a@x.example;b@x.example"\ny,a@x.example c@x.example\n')
    assert [r.email for r in R.email_list(spark, str(tmp_path / "e.csv")).orderBy("seq").collect()] == ["a@x.example", "b@x.example", "c@x.example"]
    (tmp_path / "p.json").write_text(json.dumps([{"title": " ", "role": "CEO", "source_url_email": "https://a.example/board/x", "evidence": {"source_url": None}}]))
    people = R.people_json(spark, str(tmp_path / "p.json"))
    assert people.select(R.first_title(people).alias("t"), R.source_urls(people).alias("u")).first() == ("CEO", ["https://a.example/board/x"])


def test_boundaries(spark):
    raw = spark.createDataFrame([("u", 200, "Text/HTML; charset=x", "é"), ("v", 200, "image/png", "p")], "url string, status_code int, content_type string, body string")
    assert [(r.mime, r.content_length, r.html) for r in R.fetched(raw).orderBy("url").collect()] == [("text/html", 2, "é"), ("image/png", 1, None)]
    pages = spark.createDataFrame([("http://a/x", "a"), ("http://b/x", "b"), ("http://c/x", "c")], "url string, host string")
    robots = spark.createDataFrame([("a", 200, "User-agent: *\nDisallow: /x"), ("b", 404, "User-agent: *\nDisallow: /")], "host string, status_code int, body string")
    assert {r.host: r.allowed for r in R.robots_allowed(pages, robots).collect()} == {"a": False, "b": True, "c": True}
    heads = spark.createDataFrame([("http://a/x", 200, "text/html"), ("http://b/x", 404, "text/html")], "url string, status_code int, content_type string")
    assert {r.host: r.ok for r in R.head_ok(pages, heads).collect()} == {"a": True, "b": False, "c": True}


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, ["x"], "a")], "b int, a array<string>, c string")
    W.any_columns(df, str(tmp_path / "x"))
    assert spark.read.option("header", True).csv(str(tmp_path / "x")).columns == ["a", "b", "c"]
    W.export(df.select("b", "c"), str(tmp_path / "y"))
    assert spark.read.json(str(tmp_path / "y.json")).count() == 1
    with pytest.raises(W.NothingVerified):
        W.export(df.limit(0), str(tmp_path / "z"))
    made = json.loads(W.schema_text(df, "t"))
    assert made["properties"]["a"] == {"type": "array", "items": {"type": "string"}} and made["title"] == "t"


def test_values(spark):
    rows = [("[ada](at)x(dot)example", "+44 20 7946", "BEGIN\nTITLE: Boss\nORG:Z"), (None, "none", "ORG:Acme\n"), ("a at x.example", "(555) 555-0101", "N:x")]
    df = spark.createDataFrame(rows, "e string, p string, v string")
    got = [tuple(r) for r in df.select(V.filter_email(F.col("e")), V.filter_phone(F.col("p")), V.vcard_title(F.col("v")), T.title_case(F.lit("my-3m site.com"))).collect()]
    assert got == [("ada@x.example", "+44207946", "Boss", "My-3M Site.Com"), ("", "", "Acme", "My-3M Site.Com"), ("aatx.example", "+15555550101", None, "My-3M Site.Com")]
    assert [rules.level_of(x) for x in ("vp", "c-suite", "NON DM", "x", "mgmt")] == [3, 4, 1, 0, 2]


def test_upsert_keeps_the_first_and_renews_the_rest(spark):
    schema = "seq long, company string, person_name string, role_title string, contact_type string, contact_value string, verification_status string, captured_at string, evidence string"
    one = spark.createDataFrame([(1, "A B", "Ada X", "old", "email", "a@x", "VERIFIED", "1", "e1")], schema)
    two = spark.createDataFrame([(2, "a b", " ada x ", "new", "email", "a@x", "VERIFIED", "2", "e2"), (3, "C", "Ben", "r", "email", "b@x", "VERIFIED", "3", "e3")], schema)
    got = {r.contact_value: (r.company, r.person_name, r.role_title, r.captured_at, r.seq) for r in C.upserted(C.upserted(None, one), two).collect()}
    assert got == {"a@x": ("A B", "Ada X", "new", "2", 1), "b@x": ("C", "Ben", "r", "3", 3)}
    both = C.upserted(C.upserted(C.upserted(None, one), two), two)
    assert both.count() == 2


def test_budget_like_a_sequential_run(spark):
    import random

    rnd = random.Random(4)
    pages = [(k, f"d{rnd.randrange(5)}", rnd.random() < 0.5) for k in range(200)]
    static, heads, total, want = {}, {}, 0, {}
    for k, d, wants in pages:
        static[d] = static.get(d, 0) + 1
        h = heads.get(d, 0)
        why = ""
        if wants:
            if h / (static[d] + h) >= 0.2:
                why = "quota"
            elif h >= 2:
                why = "domain cap"
            elif total >= 7:
                why = "run cap"
            else:
                heads[d] = h + 1
                total += 1
        want[k] = (wants and not why, why)
    df = spark.createDataFrame(pages, "seq long, domain string, wants boolean")
    assert {r.seq: (r.granted, r.denial) for r in routing.headless_grants(df, per_run=7).collect()} == want


def test_stream_costs_like_a_table(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = ops.windowed_costs(stream).writeStream.outputMode("complete").format("memory").queryName("costs").start()
    q.processAllAvailable()
    q.stop()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = lambda df: sorted((r.window_start, r.method, r.pages) for r in df.collect())
    assert key(spark.table("costs")) == key(ops.windowed_costs(events))
