"""Pages to contact candidates: a table-generating step in Python, everything about the candidates in Catalyst.

A task parses each page once and emits flat candidate rows; the HTML goes no further. Which candidates are taken (domains,
lengths, cross-domain scores, one e-mail and phone for each person) is decided by columns and windows afterwards.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import contact_values as V
from ..functions import text as T
from ..functions import urls as U
from ..sources.html import Node, first, parse, select
from . import routing

#: Where cards, names and titles are looked for, best first. Fixed values.
CARDS = (
    ".entry-team-info", ".fusion-layout-column.bg-green.text-white.text-center", ".person, .team-member, .employee, .staff-member", ".bio, .biography, .profile",
    ".card .person-info, .member-card, .profile-card, .team-card", "[data-person], [data-team-member]", "article.person, section.team-member, article.profile",
    ".elementor-team-member, .team-member__content, .elementor-widget-team-member, .our-team, .team-grid article", "[class*='team-member']", "[class*='member-card']", "[class*='team-info']",
    "[class*='team']", "[class*='people']", "[class*='person']", "[class*='staff']", "[class*='member']", "[class*='attorney']", "[class*='lawyer']",
)
NAMES = ("h1, h2, h3, h4", ".name, .person-name, .full-name, .profile-name", ".heading, .card-title, .profile-header h2, .profile-header h3", "strong:first-child, b:first-child")
TITLES = (".title, .job-title, .position, .role, .position-title", ".subtitle, .description:first-of-type, .profile-title, .card-subtitle", "em, i, .italic", "p:first-of-type, .bio p:first-child", "h3 + p, h4 + p")
#: Headings and labels that are no names. Fixed values.
SECTIONS = frozenset((
    "our team", "team", "people", "staff", "contact", "contacts", "news", "press", "mailing address", "branch hours", "business services team", "executive team", "support", "department", "services", "contact us", "resources",
))
#: Titles that say nothing, and parts of titles that are passed over. Fixed values.
NO_ROLES = frozenset(("email", "areas of focus:", "coming soon", "open seat"))
MINOR_ROLES = ("paralegal", "legal administrator", "legal administrative", "assistant", "accountant", "marketing", "retired", "intern", "receptionist")
#: Where the company stands, best first, and headings that are no companies. Fixed values.
COMPANIES = ("title", "h1:first-of-type", ".company-name, .organization", "[data-company], [data-organization]", ".site-title, .brand-title")
NO_COMPANY = re.compile(r"^(Contact|Contacts|News(?:\s*&\s*Insights)?|Press|Team|People|About)\b", re.I)
#: Boxes of links, in a card and (by parts of their classes) beside it. Fixed values.
LINK_BOXES = ".eti-links, .links, .contact, .contacts, .actions, .icons, [class*='links']"
LINK_BOX_WORDS = ("eti-links", "links", "contact", "contacts", "actions", "icons")
#: Words of links that lead to people, in three languages. Fixed values.
LINK_WORDS = (
    "team", "leadership", "management", "people", "staff", "executives", "board", "about", "contacts", "contact", "команда", "руководство", "менеджмент", "дирек", "о компании", "контакты", "совет директоров",
    "leitung", "über uns", "ueber uns", "kontakt", "impressum", "mitarbeiter", "vorstand", "geschäftsführung", "geschaeftsfuehrung",
)
#: Fixed value.
REVEAL = re.compile(r"\b(show|reveal|display|показать|открыть)\s*(e-?mail|email|почт\w+|адрес)\b", re.I)
EMAIL, PHONE = re.compile(V.EMAIL.removeprefix("(?i)"), re.I), re.compile(V.PHONE)
HONORIFIC = re.compile(r"^(Dr|Mr|Ms|Mrs)\.\s+")


def is_name(text: str) -> bool:
    words = text.split()
    return len(words) >= 2 and text.lower() not in SECTIONS and all(any(c.isalpha() for c in w) for w in words[:3])


def name_of(card: Node) -> tuple[Node, str] | None:
    """The first match of each group of selectors is tried; the name has to be one without its honorific, too."""
    for selector in NAMES:
        node = first(card, selector)
        if node is not None and is_name(node.text()):
            name = HONORIFIC.sub("", node.text())
            return (node, name) if is_name(name) else None
    return None


def is_role(text: str) -> bool:
    """Titles that say nothing count, for they end the search; role_of makes them Unknown."""
    low = text.lower()
    return len(text) >= 3 and (low in NO_ROLES or not any(w in low for w in MINOR_ROLES))


def _second_line(paragraph: Node) -> str:
    """What stands between the first and the second line break."""
    lines: list[list[str]] = [[]]
    stack: list[Node | str] = list(reversed(paragraph.children))
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            lines[-1].append(item)
        elif item.tag == "br":
            lines.append([])
        else:
            stack += reversed(item.children)
    return " ".join(" ".join(lines[1]).split()) if len(lines) > 1 else ""


def role_of(card: Node, name: Node) -> str:
    """The second line of the name's paragraph, the paragraph after it, else the first title; else Unknown."""
    tries = [_second_line(name.parent)] if name.parent is not None and name.parent.tag == "p" else []
    paragraphs = [n for n in (first(card, ".fusion-text") or card).walk() if n.tag == "p"]
    holders = {id(n) for n in (name, *name.ancestors())}
    own = next((k for k, p in enumerate(paragraphs) if id(p) in holders), None)
    if own is not None:
        tries += [p.text() for p in paragraphs[own + 1 : own + 2]]
    tries += [n.text()[:200] for s in TITLES if (n := first(card, s)) is not None]
    role = next(filter(is_role, tries), "Unknown")
    return "Unknown" if role.lower() in NO_ROLES else role


def root_of(node: Node) -> Node:
    """Up to three steps up to where at least three siblings look alike (tag and first two classes)."""
    at = node
    for _ in range(3):
        if at.parent is None or not at.parent.tag:
            break
        look = lambda n: (n.tag, tuple(n.classes[:2]))
        if sum(look(e) == look(at) for e in at.parent.elements()) >= 3:
            return at
        at = at.parent
    return node


def distance(a: Node, b: Node) -> int:
    up = {id(n): k for k, n in enumerate((a, *a.ancestors()))}
    return next((k + up[id(n)] for k, n in enumerate((b, *b.ancestors())) if id(n) in up), 1 << 30)


def _nearest(nodes: list[Node], name: Node) -> Node | None:
    return min(nodes, key=lambda n: (distance(name, n), n.order), default=None)


def _link_box(card: Node) -> Node | None:
    """The box of links in the card, else the first of its siblings that looks like one."""
    inside = first(card, LINK_BOXES)
    if inside is not None or card.parent is None:
        return inside
    return next((e for e in card.parent.elements() if e is not card and any(w in e.attrs.get("class", "").lower() for w in LINK_BOX_WORDS)), None)


def _nearest_link(card: Node, name: Node, scheme: str) -> Node | None:
    """The link nearest to the name, in the card or, if it has none, in its box of links."""
    for box in (card, _link_box(card)):
        found = [n for n in box.walk() if n.tag == "a" and n.attrs.get("href", "").lower().startswith(scheme)] if box is not None else []
        if found:
            return _nearest(found, name)
    return None


def _hinted(card: Node, words: tuple[str, ...]) -> str:
    """Texts and labels of elements whose label names one of the words."""
    found = [n for n in card.walk() if any(w in (n.attrs.get("aria-label", "") + " " + n.attrs.get("title", "")).lower() for w in words)]
    return " ".join(f"{n.text()} {n.attrs.get('aria-label', '')} {n.attrs.get('title', '')}" for n in found)


def card_rows(card: Node, base: str, selector: str) -> Iterator[dict]:
    """Candidates of one card: (person_name, role_title, contact_type, value, method, rank, selector, quote)."""
    found = name_of(card)
    if found is None:
        return
    name_node, name = found
    role = role_of(card, name_node)
    links = [n for n in card.walk() if n.tag == "a" and n.attrs.get("href")]
    text = card.text()
    signs = {"show_trigger": bool(REVEAL.search(text)), "has_phone": any("tel:" in n.attrs["href"] for n in links) or bool(PHONE.search(text)), "has_vcard": any(n.attrs["href"].endswith(".vcf") for n in links)}

    def row(kind: str, value: str, method: str, rank: int, where: str, quote: str, shown: str = "") -> dict:
        return {"person_name": name, "role_title": role, "contact_type": kind, "value": value, "shown": shown, "method": method, "rank": rank, "selector_or_xpath": f"{selector} {where}", "verbatim_quote": quote, **signs}

    mailto = _nearest_link(card, name_node, "mailto:")
    if mailto is not None:
        yield row("email", mailto.attrs["href"], "mailto", 0, "a[href*='mailto:']", mailto.text() or mailto.attrs["href"], mailto.text())
    else:
        for rank, source in enumerate((_hinted(card, ("email", "e-mail")), text), 1):
            yield row("email", "", "text", rank, ":text-email", source, source)
    tel = _nearest_link(card, name_node, "tel:")
    if tel is not None:
        yield row("phone", tel.attrs["href"][4:], "tel", 0, "a[href*='tel:']", tel.text() or tel.attrs["href"])
    else:
        for rank, source in enumerate((_hinted(card, ("phone", "tel")), text), 1):
            for hit in PHONE.findall(source):
                yield row("phone", hit, "text", rank, ":text-phone", hit)
    for n in links:
        path = urlsplit(n.attrs["href"]).path.lower()
        if path.endswith(".vcf") and any(t in path for t in re.findall("[a-z]+", name.lower())):
            yield row("link", urljoin(base, n.attrs["href"]), "vcf", 0, "a[href$='.vcf']", n.text() or n.attrs["href"])


def header_kind(text: str) -> str | None:
    """The first rule that fits, so a first name's column counts as the name's."""
    low = text.lower()
    for kind, words in (("name", ("name", "имя", "фио")), ("title", ("title", "position", "role", "должность")), ("email", ("email", "e-mail", "почта")), ("phone", ("phone", "tel", "телефон"))):
        if any(w in low for w in words):
            return kind
    return None


def table_rows(page: Node, base: str) -> Iterator[dict]:
    """One person for each row of a table with header cells."""
    for table in (n for n in page.walk() if n.tag == "table"):
        rows = [n for n in table.walk() if n.tag == "tr"]
        heads = [c for c in rows[0].elements() if c.tag in ("th", "td")] if rows and any(n.tag == "th" for n in table.walk()) else []
        columns: dict[str, int] = {}
        for k, head in enumerate(heads):
            if kind := header_kind(head.text()):
                columns.setdefault(kind, k)
        for tr in rows[1:] if "name" in columns else []:
            cells = [c for c in tr.elements() if c.tag in ("td", "th")]
            cell = lambda kind: cells[columns[kind]] if columns.get(kind, 99) < len(cells) else None  # noqa: E731, B023
            if (c := cell("name")) is None or not is_name(name := c.text()):
                continue
            role = cell("title").text() if cell("title") is not None else ""
            common = {"person_name": name, "role_title": role or "Unknown", "show_trigger": False, "has_phone": False, "has_vcard": False, "rank": 0}
            if (c := cell("email")) is not None:
                a = next((n for n in c.walk() if n.attrs.get("href", "").lower().startswith("mailto:")), None)
                yield {**common, "contact_type": "email", "value": a.attrs["href"] if a is not None else "", "shown": c.text(), "method": "mailto" if a is not None else "text", "selector_or_xpath": "tr td", "verbatim_quote": c.text()}
            if (c := cell("phone")) is not None:
                for hit in PHONE.findall(c.text())[:1]:
                    yield {**common, "contact_type": "phone", "value": hit, "shown": "", "method": "text", "selector_or_xpath": "tr td", "verbatim_quote": c.text()}
            for a in (n for n in tr.walk() if n.attrs.get("href", "").endswith(".vcf")):
                yield {**common, "contact_type": "link", "value": urljoin(base, a.attrs["href"]), "shown": "", "method": "vcf", "selector_or_xpath": "tr a[href$='.vcf']", "verbatim_quote": a.text() or a.attrs["href"]}


def repeating(page: Node) -> list[Node]:
    """Direct children of the main part that look alike, three or more."""
    box = first(page, "main") or first(page, "body") or page
    look = Counter((e.tag, tuple(e.classes[:2])) for e in box.elements())
    return [e for e in box.elements() if look[e.tag, tuple(e.classes[:2])] >= 3]


def company_of(page: Node, url: str) -> str:
    """The first of COMPANIES with a text, cut at its first hyphen or bar, that is no heading; else the host in title case."""
    for selector in COMPANIES:
        node = first(page, selector)
        shown = re.sub(r"\s*[-|].*$", "", node.text()) if node is not None else ""
        if shown and not NO_COMPANY.match(shown):
            return shown[:100]
    return urlsplit(url).netloc.replace("www.", "").title()


def sweep_rows(page: Node) -> Iterator[dict]:
    """Rendered pages: every mail and telephone link with the heading of its list item, else the nearest valid heading of a
    level before it, h2 before h3 before h4."""
    headings = [n for n in page.walk() if n.tag in ("h2", "h3", "h4")]
    for a in page.walk():
        href = a.attrs.get("href", "") if a.tag == "a" else ""
        kind = "email" if href.lower().startswith("mailto:") else "phone" if href.lower().startswith("tel:") else None
        if kind is None:
            continue
        item = next((n for n in a.ancestors() if n.tag == "li" and "list-item" in n.attrs.get("class", "")), None)
        found = name_of(item) if item is not None else None
        name = found[1] if found else None
        if name is None:
            outer = {id(n) for n in a.ancestors()}
            for level in ("h2", "h3", "h4"):
                before = [h for h in headings if h.tag == level and h.order < a.order and id(h) not in outer]
                if before and is_name(t := HONORIFIC.sub("", before[-1].text())):
                    name = t
                    break
        if name:
            value = href if kind == "email" else href[4:]
            yield {"person_name": name, "role_title": role_of(item, found[0]) if found else "Unknown", "contact_type": kind, "value": value, "shown": a.text(), "method": "mailto" if kind == "email" else "tel", "rank": 0,
                   "selector_or_xpath": f"a[href*='{'mailto' if kind == 'email' else 'tel'}:']", "verbatim_quote": a.text() or href, "show_trigger": False, "has_phone": kind == "phone", "has_vcard": False}


def page_rows(html: str | None, url: str, rendered: bool = False) -> Iterator[dict]:
    page = parse(html)
    company = company_of(page, url)
    foot = " ".join(n.text() for n in page.walk() if n.tag == "footer" or n.attrs.get("class", "").startswith(("footer", "contact"))).lower()
    mails = Counter(m.lower() for n in page.walk() if n.attrs.get("href", "").lower().startswith("mailto:") for m in re.findall(r"@([\w.-]+)", n.attrs["href"]))
    found: list[dict] = list(sweep_rows(page)) if rendered else []
    if not found:
        seen: set[int] = set()
        for selector in CARDS:
            for node in select(page, selector):
                card = root_of(node)
                if id(card) not in seen:
                    seen.add(id(card))
                    found += card_rows(card, url, selector.split(",")[0])
        if not seen:
            found = list(table_rows(page, url)) or [r for card in repeating(page) for r in card_rows(card, url, "main > *")]
    for place, row in enumerate(found):
        yield row | {"company": company, "place": place, "footer_text": foot, "page_mails": dict(mails)}


SCHEMA = "page_id long, page_url string, place int, company string, person_name string, role_title string, contact_type string, value string, shown string, method string, rank int, selector_or_xpath string, verbatim_quote string, show_trigger boolean, has_phone boolean, has_vcard boolean, footer_text string, page_mails map<string,int>"


def candidates(pages: DataFrame, rendered: bool = False) -> DataFrame:
    """(page_id, url, html) to the rows of SCHEMA. Every page is parsed: signs of an address may be spelled out, be
    character references or lie in several elements, so the raw HTML can't tell that there is none."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(SCHEMA)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                rows += [{**r, "page_id": page_id, "page_url": url, "page_mails": list(r["page_mails"].items())} for r in page_rows(html, url or "", rendered)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return pages.where(F.col("html").isNotNull()).select("page_id", "url", "html").mapInArrow(run, kind)


def accepted(rows: DataFrame, site_counts: DataFrame | None = None, allow_free: bool = False) -> DataFrame:
    """Candidates to contacts: values read, telephone numbers checked, addresses of other domains scored, the best rank of
    each person and kind kept, at the place of their first one. site_counts: (page_id, domain, site_count) of routing.site_counts, if there is any."""
    email = F.when(F.col("method") == "mailto", V.from_mailto(F.col("value"), F.col("shown"))).otherwise(F.lower(F.coalesce(F.nullif(F.regexp_extract("shown", V.EMAIL, 0), F.lit("")), V.deobfuscated(F.col("shown")))))
    d = T.digits(F.col("value"))
    phone = F.when(F.col("method") == "tel", d).when(V.plausible_phone(d), d)
    value = F.when(F.col("contact_type") == "email", email).when(F.col("contact_type") == "phone", phone).otherwise(F.col("value"))
    rows = rows.withColumn("contact_value", value).where(F.col("contact_value").isNotNull() & ((F.col("contact_type") != "email") | F.col("contact_value").rlike(r"^[^@]+@[^@]+\.[^@]+$")))
    rows = rows.withColumn("email_domain", F.substring_index("contact_value", "@", -1)).withColumn("site_host", U.authority(F.col("page_url")))
    if site_counts is None:
        rows = rows.withColumn("site_count", F.lit(0))
    else:
        known = site_counts.select("page_id", F.col("domain").alias("email_domain"), "site_count")
        rows = rows.join(known, ["page_id", "email_domain"], "left").fillna(0, ["site_count"])
    rows = rows.withColumns({
        "has_title": F.col("role_title") != "Unknown", "from_mailto": F.col("method") == "mailto", "page_count": F.coalesce(F.col("page_mails")[F.col("email_domain")], F.lit(0)),
        "in_footer": F.col("footer_text").contains(F.col("email_domain")), "negative_zone": U.negative_zone(F.col("page_url")),
    })
    rows = rows.withColumn("why", F.when(F.col("contact_type") == "email", routing.accepted_email(allow_free)).otherwise("")).where("why <> 'rejected'")
    evidence = F.struct(F.col("page_url").alias("source_url"), "selector_or_xpath", "verbatim_quote")
    best = F.min_by(F.struct("company", "role_title", "contact_value", evidence.alias("evidence"), "why"), F.struct("rank", "place"))
    key = F.when(F.col("contact_type") == "link", F.col("contact_value")).otherwise("")
    by = rows.groupBy("page_id", "person_name", "contact_type", key.alias("_link")).agg(best.alias("b"), F.min("place").alias("place"))
    return by.select("page_id", "place", "person_name", "contact_type", "b.*")


def follow_ups(cards: DataFrame, pages: DataFrame, most: int = routing.FOLLOW_UPS) -> DataFrame:
    """Contacts of profile pages for cards without any: cards (page_id, place, person_name, profile_url), pages (url, html) as
    fetched. The first `most` cards of a page are followed; of a profile only contacts under the card's own name count."""
    from pyspark.sql import Window

    tried = cards.withColumn("_n", F.row_number().over(Window.partitionBy("page_id").orderBy("place"))).where(F.col("_n") <= most).drop("_n")
    wanted = tried.select(F.col("profile_url").alias("url")).distinct().join(pages, "url").select(F.xxhash64("url").alias("page_id"), "url", "html")
    found = accepted(candidates(wanted)).select("evidence.source_url", "person_name", "contact_type", "contact_value")
    both = tried.join(found.withColumnRenamed("person_name", "_name"), F.col("profile_url") == F.col("source_url"))
    return both.where(F.lower("person_name") == F.lower("_name")).select("page_id", "place", "person_name", "contact_type", "contact_value", "source_url")


def links(pages: DataFrame, most: int = 20) -> DataFrame:
    """Links of a page worth following: (page_id, place, link), same site, without query or fragment, once each, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, place, out, texts = [], [], [], []
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                for k, a in enumerate(n for n in parse(html).walk() if n.tag == "a" and n.attrs.get("href")):
                    ids.append(page_id), place.append(k), out.append(urljoin(url or "", a.attrs["href"])), texts.append(f"{a.text()} {a.attrs['href']}".lower())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(place, pa.int32()), pa.array(out, pa.string()), pa.array(texts, pa.string())], names=["page_id", "place", "link", "words"])

    raw = pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, place int, link string, words string")
    rows = raw.join(pages.select(F.col("page_id").alias("of"), F.col("url").alias("base")), F.col("page_id") == F.col("of"))
    rows = rows.where(U.any_in(F.col("words"), LINK_WORDS) & ~F.col("link").rlike("[?#]") & U.same_site(F.col("base"), F.col("link")))
    once = rows.groupBy("page_id", U.normalize(F.col("link")).alias("link")).agg(F.min("place").alias("place"))
    from pyspark.sql import Window

    return once.withColumn("n", F.row_number().over(Window.partitionBy("page_id").orderBy("place"))).where(F.col("n") <= most).select("page_id", F.col("n").alias("place"), "link")
