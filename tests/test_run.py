import datetime
import json
import random

from factweave.__main__ import main
from factweave.operators import routing
from factweave.plans import run

CARD = '<div class="team-member"><h3>{n}</h3><p class="title">{t}</p>{m}</div>'
SCHEMA = "page_id long, url string, status_code int, mime string, html string, fetched_at timestamp, blocked_by_robots boolean"


def test_from_pages_to_exports(spark, tmp_path, capsys):
    at = datetime.datetime(2024, 5, 1)
    mail = "<a href='mailto:ada@firm.example'>m</a>"
    rows = [
        (1, "https://firm.example/team", 200, "text/html", "<title>Firm</title>" + CARD.format(n="Ada Arden", t="Managing Director", m=mail + "<a href='tel:5555550101'>call me</a>"), at, False),
        (2, "https://www.firm.example/about", 200, "text/html", "<title>Firm</title>" + CARD.format(n="Ada Arden", t="Analyst", m=mail), at, None),
        (3, "https://firm.example/people", 404, "text/html", CARD.format(n="Ben Birch", t="CEO", m=mail), at, False),
        (4, "https://firm.example/our-team", 200, "text/html", "<div data-reactroot></div>123", at, False),
    ]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "f"))
    spark.createDataFrame([(4, "<ul><li class='list-item'><h3>Cleo Cole</h3><a href='mailto:cleo@firm.example'>c</a></li></ul>")], "page_id long, html string").write.parquet(str(tmp_path / "r"))
    out = str(tmp_path / "out")
    assert main(["run", "--fetches", str(tmp_path / "f"), "--rendered", str(tmp_path / "r"), "--out", out, "--decision-only", "--print-ecr-summary"]) == 0
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert stats["verified"] == 4 and stats["verdict"] == "OK"
    people = {r.person_name: (r.role_title, r.email, r.phone) for r in spark.read.json(out + "/contacts_people.json").collect()}
    assert people == {"Ada Arden": ("Managing Director", "ada@firm.example", "5555550101"), "Cleo Cole": ("Unknown", "cleo@firm.example", "")}
    assert [r.person_name for r in spark.read.json(out + "/decision_people.json").collect()] == ["Ada Arden"]
    assert main(["run", "--fetches", str(tmp_path / "none"), "--out", out]) == 2
    spark.createDataFrame(rows[2:3], SCHEMA).write.parquet(str(tmp_path / "g"))
    assert main(["run", "--fetches", str(tmp_path / "g"), "--out", out]) == 3


def test_filter_of_a_people_file(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"title": "Partner", "email": "INFO@x.example", "phone": "(555) 555-0101"}, {"title": "Analyst", "email": None, "phone": None}]))
    assert main(["filter", "--people", str(tmp_path / "p.json"), "--out", str(tmp_path / "o")]) == 0
    got = spark.read.json(str(tmp_path / "o/decision.json")).collect()
    assert [(r.title, r.email, r.phone, r.decision_level, r.decision_reasons) for r in got] == [("Partner", "info@x.example", "+15555550101", "VP_PLUS", ["email:generic", r"title:\bpartner\b"])]


def test_rendering_keeps_to_the_budgets(spark):
    at = datetime.datetime(2024, 5, 1)
    rows = [(k, f"https://{host}.example/our-team?{k}", 200, "text/html", "<div data-reactroot></div>", at, False) for k, host in enumerate(["a"] * 12 + [f"h{n}" for n in range(12)])]
    rendered = [(r[0], f"<title>Firm</title><ul><li class='list-item'><h3>Cleo Cole</h3><a href='mailto:c{r[0]}@{r[1][8:].split('/')[0]}'>c</a></li></ul>") for r in rows]
    made = run.contacts_of(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rendered, "page_id long, html string")).collect()
    # the first host is granted its first page and its fifth, before which one of five would be a fifth; then the run's cap of ten holds
    assert sorted(r.seq // 1_000_000 for r in made) == [0, 4, *range(12, 20)]


def test_running_counts_over_chunks(spark):
    rng = random.Random(5)
    hosts = [(k, rng.choice(["a", "a", "b", None])) for k in range(0, 60, 1)]
    mails = [(k, rng.choice("xy"), rng.randint(1, 3)) for k, _ in hosts for _ in range(2)]
    want, running, last = set(), {}, None
    for k, host in hosts:
        if host is None or host != last:
            running = {}
        last = host
        here = {d: sum(n for s, e, n in mails if s == k and e == d) for d in {e for s, e, _ in mails if s == k}}
        for d, n in here.items():
            running[d] = running.get(d, 0) + n
            want.add((k, d, n, running[d]))
    pages, found = spark.createDataFrame(hosts, "seq long, host string"), spark.createDataFrame(mails, "seq long, domain string, n int")
    for bits in (1, 3, 16):
        assert {tuple(r) for r in routing.site_counts(pages, found, bits).collect()} == want
