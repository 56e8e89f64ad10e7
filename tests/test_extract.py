from factweave.operators import extract as E
from factweave.sources.html import first, parse, select

CARD = '<div class="team-member"><h3>{name}</h3><p class="title">{title}</p>{more}</div>'
PAGES = {
    1: ("https://www.firm.example/team", "<title>Firm - Team</title>" + CARD.format(name="Ada Arden", title="Partner", more='<a href="mailto:Ada.Arden@firm.example?subject=Hi">write</a><a href="tel:+1 (555) 555-0101">call</a>') + CARD.format(name="Dr. Ben Birch", title="Analyst", more='<a href="mailto:broken">ben@firm.example</a>')),
    2: ("https://firm.example/our-team", CARD.format(name="Cleo Cole", title="", more='<span aria-label="Email cleo@firm.example">icon</span><span aria-label="Phone (555) 555-0102">icon</span>')),
    3: ("https://firm.example/team", CARD.format(name="Dov Dune", title="Areas of Focus:", more="<p>20240602</p>") + CARD.format(name="Ada Elm", title="Lead", more="<p>Phone: +1 (401) 555-0123</p>")),
    4: ("https://firm.example/our-team", CARD.format(name="Ada Arden", title="Partner", more='<a href="/v/ada.vcf">card</a><a href="/v/zed.vcf">card</a>')),
    5: ("https://firm.example/team", CARD.format(name="Mailing Address", title="", more="x@firm.example") + "<footer>info@firm.example</footer>"),
    6: ("https://firm.example/about", "<table><tr><th>Name</th><th>Title</th><th>Email</th><th>Phone</th></tr><tr><td>Eve Elm<td>Head of Data<td>eve (at) firm.example<td>555 555 0104</table>"),
    7: ("https://firm.example/team", CARD.format(name="Ada Birch", title="Partner", more='<a href="mailto:ada@other.example">m</a>')),
    8: ("https://firm.example/team", CARD.format(name="Ada Cole", title="Partner", more='<a href="mailto:ada@other.example">m</a><a href="tel:5555550105">t</a>')),
    10: ("https://firm.example/team", CARD.format(name="Ada Fenn", title="Partner", more="<p>ada at firm dot example</p>")),
    9: ("https://firm.example/team", CARD.format(name="Ada Dune", title="Partner", more='<a href="mailto:a@firm.example,b@firm.example">m</a>')),
}


def test_tree_and_selectors():
    page = parse("<ul><li class='a b'>one<li>two</ul><h3>T</h3><p>after<br>x</p><img src=x><p>last")
    assert [n.text() for n in select(page, "li")] == ["one", "two"] and first(page, "li.a.b").text() == "one"
    assert first(page, "h3 + p").text() == "after x" and first(page, "p:first-of-type").text() == "after x"
    assert [n.tag for n in select(page, "[src], ul li:first-child")] == ["li", "img"] and parse(None).text() == ""


def test_contacts_of_golden_pages(spark):
    pages = spark.createDataFrame([(k, u, h, 1) for k, (u, h) in PAGES.items()] + [(99, None, None, 1), (98, "https://x.example", "", 1)], "page_id long, url string, html string, company int")
    got = {}
    for r in E.accepted(E.candidates(pages)).collect():
        got.setdefault(r.page_id, set()).add((r.person_name, r.role_title, r.contact_type, r.contact_value))
    assert got == {
        1: {("Ada Arden", "Partner", "email", "ada.arden@firm.example"), ("Ada Arden", "Partner", "phone", "15555550101"), ("Ben Birch", "Analyst", "email", "ben@firm.example")},
        2: {("Cleo Cole", "Unknown", "email", "cleo@firm.example"), ("Cleo Cole", "Unknown", "phone", "5555550102")},
        3: {("Ada Elm", "Lead", "phone", "14015550123")},
        4: {("Ada Arden", "Partner", "link", "https://firm.example/v/ada.vcf")},
        6: {("Eve Elm", "Head of Data", "email", "eve@firm.example"), ("Eve Elm", "Head of Data", "phone", "5555550104")},
        10: {("Ada Fenn", "Partner", "email", "ada@firm.example")},
        8: {("Ada Cole", "Partner", "email", "ada@other.example"), ("Ada Cole", "Partner", "phone", "5555550105")},
    }


def test_rendered_sweep_and_company():
    html = "<title>Team - Acme</title><h1>Acme | Lawyers</h1><h2>Ada Arden</h2><h3>Not</h3><a href='tel:+1 (555) 555-0101'>t</a><ul><li class='list-item'><h4>Ben Birch</h4><a href='mailto:b@acme.example'>b</a></li></ul>"
    rows = list(E.page_rows(html, "https://acme.example/team", rendered=True))
    assert [(r["person_name"], r["contact_type"], r["company"]) for r in rows] == [("Ada Arden", "phone", "Acme"), ("Ben Birch", "email", "Acme")]
    assert E.company_of(parse(""), "https://my-3m.example/x") == "My-3M.Example"


def test_names_roles_and_companies():
    names = {"Ada Arden": True, "Ada": False, "Our Team": False, "Business Services Team": False, "Executive Team": False, "Ada 3": False, "Ada van der 3": True, "Élan Ünal": True, "": False}
    assert {n: E.is_name(n) for n in names} == names
    roles = {
        "<h3>Ada Arden</h3><p class='title'>Partner</p>": "Partner",
        "<h3>Ada Arden</h3><p class='title'>Retired</p><em>Partner</em>": "Partner",
        "<h3>Ada Arden</h3><p class='title'>Executive Assistant</p>": "Unknown",
        "<h3>Ada Arden</h3><p class='title'>Coming soon</p><em>Partner</em>": "Unknown",
        "<h3>Ada Arden</h3><p class='title'>Open Seat</p>": "Unknown",
        "<h3>Ada Arden</h3><p class='title'>VP</p>": "Unknown",
        "<p><strong>Ada Arden</strong><br>Head <b>of Data</b><br>Berlin</p><p>Other</p>": "Head of Data",
        "<p><strong>Ada Arden</strong></p><p>Chair</p><p>Other</p>": "Chair",
        "<h3>Ada Arden</h3><p class='title'>" + "x" * 300 + "</p>": "x" * 200,
    }
    for html, role in roles.items():
        card = parse(f"<div>{html}</div>").elements()[0]
        assert E.role_of(card, E.name_of(card)[0]) == role, html
    assert E.name_of(parse("<h3>Dr. Ada</h3><p class='name'>Ben Birch</p>")) is None
    companies = {
        "<title>Firm - Team</title>": "Firm", "<title>Team - Firm</title><h1>Firm &amp; Sons</h1>": "Firm & Sons", "<title>News &amp; Insights | F</title><p class='organization'>Org</p>": "Org",
        "<title>About us</title><h1>People</h1><div data-company='x'>Data Co</div>": "Data Co", "<title>Home</title>": "Home", "<title>Teamwork | x</title>": "Teamwork",
        "<title>Contacts</title><h1>Press</h1><span class='brand-title'>Brand</span>": "Brand", "": "Acme.Example",
    }
    assert {h: E.company_of(parse(h), "https://www.acme.example/x") for h in companies} == companies


def test_links_of_a_card_may_stand_beside_it():
    html = "<section><div class='team-member'><h3>Ada Arden</h3>{inside}</div><div class='x'><a href='mailto:x@acme.example'>x</a></div><ul class='card-Links'><li><a href='mailto:ada@acme.example'>m</a><a href='tel:5555550101'>t</a></ul></section>"
    found = lambda inside: {(r["contact_type"], r["value"]) for r in E.page_rows(html.format(inside=inside), "https://acme.example/team") if r["method"] != "text"}
    assert found("") == {("email", "mailto:ada@acme.example"), ("phone", "5555550101")}
    assert found("<a href='mailto:a.arden@acme.example'>m</a>") == {("email", "mailto:a.arden@acme.example"), ("phone", "5555550101")}
    assert found("<p class='actions'>none</p>") == set()  # the card has a box of its own


def test_links(spark):
    html = "<a href='/team/'>Us</a><a href='/team'>again</a><a href='/x'>Kontakt</a><a href='/about?x=1'>About</a><a href='https://else.example/team'>Team</a><a href='/y'>none</a><a href='HTTPS://WWW.a.example/board'>b</a>"
    pages = spark.createDataFrame([(1, "https://a.example/", html)], "page_id long, url string, html string")
    assert [(r.place, r.link) for r in E.links(pages).orderBy("place").collect()] == [(1, "https://a.example/team"), (2, "https://a.example/x"), (3, "https://www.a.example/board")]
