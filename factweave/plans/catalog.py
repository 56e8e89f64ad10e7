"""The registered queries over the engine's own operators, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import contact_values as V
from ..functions import text as T
from ..functions import urls as U
from ..operators import contacts as C
from ..operators import brand, extract, probe, routing, rules
from .relations import CONTACTS_SQL, PARSER_VERSION, SCREENSHOT, contacts, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def put(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            ORACLES[query.__name__] = sql
        return query

    return put


# --- SQL text that several oracles share -----------------------------------------------------------------------------

_SCHEME, _NETLOC, _PATH = (f"regexp_extract({{u}}, '^(?:([A-Za-z][A-Za-z0-9+.\\-]*):)?(?://([^/?#]*))?([^?#]*)', {k})" for k in (1, 2, 3))


def _norm(u: str) -> str:
    scheme, netloc, path = (x.format(u=u) for x in (_SCHEME, _NETLOC, _PATH))
    return f"(CASE WHEN {scheme} = '' THEN '' ELSE lower({scheme}) || ':' END || CASE WHEN contains({u}, '//') THEN '//' || lower({netloc}) ELSE '' END || CASE WHEN {path} = '/' THEN '/' ELSE rtrim({path}, '/') END)"


def _report(u: str) -> str:
    return f"regexp_replace({_norm(u)}, '^([a-z][a-z0-9+.\\-]*:)?//www\\.', '\\1//')"


def _registrable(h: str) -> str:
    labels = f"string_split({h}, '.')"
    return f"(CASE WHEN len({labels}) < 2 THEN {h} WHEN len({labels}) >= 3 AND {labels}[-2] IN ('co', 'com', 'org', 'net', 'gov', 'ac', 'edu') AND length({labels}[-1]) <= 3 THEN array_to_string({labels}[-3:], '.') ELSE array_to_string({labels}[-2:], '.') END)"


def _digits(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '[^0-9]', '', 'g')"


_PERSON = "trim(regexp_replace(translate(lower(person_name), ',.', '  '), '\\s+', ' ', 'g'))"
_KNOWN = "CASE WHEN trim(role_title) <> '' AND lower(trim(role_title)) <> 'unknown' THEN 1 ELSE 0 END"
_SEMANTIC = "CASE WHEN regexp_matches(lower(source_url), '/leadership|/our-team|/team') THEN 1 ELSE 0 END"
_VALUE = f"CASE WHEN contact_type = 'phone' THEN {_digits('contact_value')} ELSE lower(trim(contact_value)) END"
_C = f"""
WITH contacts AS (
    SELECT *, CASE WHEN trim(verbatim_quote) = '' THEN 'UNVERIFIED' ELSE 'VERIFIED' END AS verification_status,
           contains(lower(selector_or_xpath), 'a[href*=''mailto:'']')::INT AS is_mailto, contains(lower(selector_or_xpath), 'a[href*=''tel:'']')::INT AS is_tel,
           lower(trim(company)) AS company_key, {_PERSON} AS person_key
    FROM ({CONTACTS_SQL})
), good AS (SELECT * REPLACE (trim(company) AS company, trim(person_name) AS person_name) FROM contacts WHERE verification_status = 'VERIFIED')
"""
_BEST = f"""
, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY company_key, person_key, contact_type, {_VALUE}
               ORDER BY greatest(is_mailto, is_tel) DESC, {_SEMANTIC} DESC, {_KNOWN} DESC, length({_report('source_url')}), captured_at DESC, seq) AS rn,
           min(seq) OVER (PARTITION BY company_key, person_key, contact_type, {_VALUE}) AS place
    FROM good
), best AS (SELECT * EXCLUDE (seq, place, rn), place AS seq FROM ranked WHERE rn = 1)
"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def _verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.verified(contacts(spark, sf_dir)).drop("violations", "verification_status")


# --- pages -----------------------------------------------------------------------------------------------------------


@register(f"SELECT page_id, CASE WHEN {_SCHEME.format(u='url')} = '' THEN url ELSE {_norm('url')} END AS normalized FROM pages")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", U.normalize(F.col("url")).alias("normalized"))


@register(f"SELECT page_id, {_report('url')} AS report_url FROM pages")
def url_report_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", U.for_report(F.col("url")).alias("report_url"))


@register(f"WITH p AS (SELECT page_id, lower({_NETLOC.format(u='url')}) AS host, {_PATH.format(u='url')} AS path FROM pages) SELECT page_id, host, path, {_registrable('host')} AS registrable FROM p")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _pages(spark, sf_dir).select("page_id", U.authority(u).alias("host"), U.path(u).alias("path"), U.registrable(U.authority(u)).alias("registrable"))


@register(f"SELECT lower({_NETLOC.format(u='url')}) AS host, count(*) AS pages, count(DISTINCT {_norm('url')}) AS distinct_pages FROM pages GROUP BY 1")
def host_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _pages(spark, sf_dir).groupBy(U.authority(u).alias("host")).agg(F.count("*").alias("pages"), F.countDistinct(U.normalize(u)).alias("distinct_pages"))


@register(f"""
WITH e AS (
    SELECT page_id, unnest(list_prepend(rtrim(url, '/'), list_transform(['/about', '/team', '/leadership', '/management', '/contacts', '/contact', '/imprint', '/impressum'],
           lambda p: {_SCHEME.format(u='url')} || '://' || {_NETLOC.format(u='url')} || p))) AS page, unnest(range(9)) AS place FROM pages
), n AS (SELECT page_id, {_norm('page')} AS page, min(place) AS place FROM e GROUP BY 1, 2)
SELECT page_id AS line, page, row_number() OVER (PARTITION BY page_id ORDER BY place) AS place FROM n QUALIFY place <= 10
""")
def candidate_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _pages(spark, sf_dir).select(F.col("page_id").alias("line"), "url")
    return routing.candidates(lines).select("line", "page", F.col("place").cast("long").alias("place"))


@register(f"WITH p AS (SELECT page_id, url, row_number() OVER (PARTITION BY lower({_NETLOC.format(u='url')}) ORDER BY page_id) AS n FROM pages) SELECT page_id, url FROM p WHERE n <= 10")
def page_cap_per_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(U.authority(F.col("url"))).orderBy("page_id"))
    return _pages(spark, sf_dir).select("page_id", "url", n.alias("n")).where(F.col("n") <= routing.PAGES_PER_LINE).drop("n")


@register(f"""
WITH s AS (SELECT seq, source_url, lower({_PATH.format(u='source_url')}) AS p FROM ({CONTACTS_SQL}))
SELECT seq, regexp_matches(p, 'team|people|leadership|management|contacts|imprint|impressum') AS run_target, regexp_matches(p, '/(our-)?team|people|leadership|management') AS ingest_target,
       regexp_matches(p, '/team|/our-team|/people|/leadership|/management') AS listing, regexp_matches(lower(source_url), '/leadership|/our-team|/team') AS semantic,
       regexp_matches(p, '/press|/news|/media|/newsroom|/careers|/jobs|/vacancies|/employment|/agency') AS negative_zone FROM s
""")
def url_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("evidence.source_url")
    flags = {"run_target": U.run_target, "ingest_target": U.ingest_target, "listing": U.listing, "semantic": U.semantic, "negative_zone": U.negative_zone}
    return contacts(spark, sf_dir).select("seq", *(f(u).alias(n) for n, f in flags.items()))


_JS = ", ".join(f"CASE WHEN regexp_matches(html, '(?i){p.replace(chr(92) + 'w', '[\\w\\p{L}]')}') THEN 'js:{p}' END" for p in rules.SCRIPTED)
_HITS = " + ".join(f"contains(lower(html), '{t}')::INT" for t in rules.TARGET_TERMS)
_REASONS = f"""
    SELECT page_id, list_filter([CASE WHEN {_HITS} = 0 AND strlen(html) < 5120 THEN 'selector_hits==0 && content_length<5KiB' END,
        CASE WHEN regexp_matches(html, '(?i)Just a moment\\s*\\.\\.\\.|Enable JavaScript and cookies to continue|__cf_chl_') THEN 'anti-bot markers detected' END, {_JS},
        CASE WHEN NOT contains(lower(html), 'href="mailto:') AND NOT contains(lower(html), 'href="tel:') AND (len(regexp_extract_all(html, '{rules.CARD_CLASS}')) >= 3
             OR len(regexp_extract_all(html, '{rules.HEADING}')) >= 8) THEN 'cards_present_but_no_mailto_tel' END], lambda r: r IS NOT NULL) AS reasons
    FROM pages"""


def _escalation(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return _pages(spark, sf_dir).select("page_id", rules.escalation_reasons(F.lit("text/html"), F.octet_length(html), html, rules.term_hits(html)).alias("reasons"))


@register(f"SELECT page_id, len(reasons) > 0 AS escalate, array_to_string(reasons, '|') AS reasons FROM ({_REASONS})")
def escalation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _escalation(spark, sf_dir).select("page_id", (F.size("reasons") > 0).alias("escalate"), F.array_join("reasons", "|").alias("reasons"))


@register(f"SELECT reason, count(*) AS pages FROM (SELECT unnest(reasons) AS reason FROM ({_REASONS})) GROUP BY reason")
def escalation_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _escalation(spark, sf_dir).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("pages"))


@register(f"""
WITH p AS (SELECT page_id AS seq, lower({_NETLOC.format(u='url')}) AS domain, page_id % 3 = 0 AS wants FROM pages),
n AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY seq) AS n FROM p),
g1 AS (SELECT domain, min(seq) AS s FROM n WHERE wants GROUP BY domain),
g2 AS (SELECT n.domain, min(seq) AS s FROM n JOIN g1 ON n.domain = g1.domain WHERE wants AND seq > g1.s AND n >= 5 GROUP BY n.domain),
g AS (SELECT *, row_number() OVER (ORDER BY s) AS rank FROM (SELECT * FROM g1 UNION ALL SELECT * FROM g2)),
m AS (SELECT n.*, coalesce(rank <= 10, false) AS granted FROM n LEFT JOIN g ON n.domain = g.domain AND n.seq = g.s),
b AS (SELECT *, coalesce(sum(granted::INT) OVER (PARTITION BY domain ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m)
SELECT seq, domain, wants, granted, CASE WHEN NOT wants OR granted THEN '' WHEN before / (n + before) >= 0.2 THEN 'quota' WHEN before >= 2 THEN 'domain cap' ELSE 'run cap' END AS denial FROM b
""")
def headless_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page wants a browser."""
    rows = _pages(spark, sf_dir).select(F.col("page_id").alias("seq"), U.authority(F.col("url")).alias("domain"), (F.col("page_id") % 3 == 0).alias("wants"))
    return routing.headless_grants(rows)


@register("""
WITH t AS (SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS t FROM pages), c AS (SELECT page_id, trim(regexp_replace(t, '\\s*[-|].*$', '')) AS t FROM t)
SELECT page_id, substr(t, 1, 100) AS company FROM c
""")
def company_name_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = T.strip(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    return _pages(spark, sf_dir).select("page_id", F.substring(T.strip(F.regexp_replace(title, r"\s*[-|].*$", "")), 1, 100).alias("company"))


# --- documents -------------------------------------------------------------------------------------------------------

_ASCII_EMAIL = "(?i)\\b[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}\\b"


@register(f"SELECT doc_id, lower(unnest(regexp_extract_all(text, '{_ASCII_EMAIL}'))) AS email FROM documents WHERE contains(text, '@')")
def doc_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.col("text").contains("@"))
    return docs.select("doc_id", F.explode(V.emails(F.col("text"))).alias("e")).select("doc_id", F.lower("e").alias("email"))


@register(f"""
WITH p AS (SELECT doc_id, unnest(regexp_extract_all(text, '{V.PHONE}')) AS raw FROM documents), d AS (SELECT doc_id, {_digits('raw')} AS digits FROM p)
SELECT doc_id, CASE WHEN length(digits) = 11 AND starts_with(digits, '1') THEN substr(digits, 2) ELSE digits END AS phone FROM d
WHERE length(digits) BETWEEN 10 AND 15 AND NOT regexp_matches(digits, '^(19|20)[0-9]{{6,8}}$')
""")
def doc_phones_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.digits(F.col("raw"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(V.phones(F.col("text"))).alias("raw"))
    return rows.select("doc_id", d.alias("digits")).where(V.plausible_phone(F.col("digits"))).select("doc_id", V.without_country(F.col("digits")).alias("phone"))


@register("SELECT sha256(lower(trim(text))) AS content_hash, count(*) AS copies, min(doc_id) AS first_doc FROM documents GROUP BY 1")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.sha2(F.lower(T.strip(F.col("text"))), 256)
    return table(spark, sf_dir, "documents").groupBy(made.alias("content_hash")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"))


@register("SELECT page_id, concat_ws('_', 'static', substr(md5(url), 1, 8), substr(md5('body'), 1, 8), strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id), '%Y%m%d_%H%M%S')) || '.png' AS path FROM pages")
def screenshot_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.to_timestamp(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(secs=F.col("page_id"))
    name = F.concat_ws("_", F.lit("static"), F.substring(F.md5("url"), 1, 8), F.substring(F.md5(F.lit("body")), 1, 8), F.date_format(at, "yyyyMMdd_HHmmss"))
    return _pages(spark, sf_dir).select("page_id", F.concat(name, F.lit(".png")).alias("path"))


@register("""
WITH m AS (SELECT seq, CASE seq % 4 WHEN 0 THEN 'Write to ' || replace(replace(contact_value, '@', ' (at) '), '.', ' [dot] ') WHEN 1 THEN 'mailto: ' || contact_value WHEN 2 THEN replace(contact_value, '@', ' at ') ELSE contact_value END AS shown,
    lower(contact_value) AS email FROM (""" + CONTACTS_SQL + """) WHERE contact_type = 'email')
SELECT seq, email FROM m
""")
def email_deobfuscate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses spelled out in four ways are read back."""
    value = F.col("contact_value")
    spelled = F.replace(F.replace(value, F.lit("@"), F.lit(" (at) ")), F.lit("."), F.lit(" [dot] "))
    shown = F.when(F.col("seq") % 4 == 0, F.concat(F.lit("Write to "), spelled)).when(F.col("seq") % 4 == 1, F.concat(F.lit("mailto: "), value)).when(F.col("seq") % 4 == 2, F.replace(value, F.lit("@"), F.lit(" at "))).otherwise(value)
    rows = contacts(spark, sf_dir).where("contact_type = 'email'").select("seq", shown.alias("shown"))
    return rows.select("seq", F.lower(V.deobfuscated(F.col("shown"))).alias("email"))


# --- contacts --------------------------------------------------------------------------------------------------------


@register(_C + "SELECT seq, '' AS violations, verification_status FROM contacts")
def contacts_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.validated(contacts(spark, sf_dir)).select("seq", F.array_join("violations", ",").alias("violations"), "verification_status")


@register(_C + "SELECT seq, company, person_name, contact_type, contact_value FROM good")
def verified_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.verified(contacts(spark, sf_dir)).select("seq", "company", "person_name", "contact_type", "contact_value")


@register(_C + f"""
SELECT company, person_name, role_title, contact_type, contact_value, strftime(captured_at, '%Y-%m-%dT%H:%M:%S+00:00') AS captured_at, verification_status, {_report('source_url')} AS source_url, selector_or_xpath, verbatim_quote,
       '{SCREENSHOT}' AS dom_node_screenshot, strftime(captured_at, '%Y-%m-%dT%H:%M:%S+00:00') AS timestamp, '{PARSER_VERSION}' AS parser_version, sha256(lower(trim(verbatim_quote))) AS content_hash FROM good
""")
def export_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.flat(C.verified(contacts(spark, sf_dir)))


@register(_C + _BEST + "SELECT seq, company, person_name, role_title, contact_type, contact_value, source_url, captured_at FROM best")
def export_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.deduped(_verified(spark, sf_dir)).select("seq", "company", "person_name", "role_title", "contact_type", "contact_value", "evidence.source_url", "captured_at")


@register(_C + f"""
, a AS (SELECT *, row_number() OVER (PARTITION BY page_url, company_key, lower(trim(person_name)), contact_type, {_VALUE} ORDER BY greatest(is_mailto, is_tel) DESC, {_KNOWN} DESC, seq) AS n FROM contacts),
b AS (SELECT *, row_number() OVER (PARTITION BY page_url, company_key, lower(trim(person_name)), contact_type ORDER BY greatest(is_mailto, is_tel) DESC, {_KNOWN} DESC, seq) AS k FROM a WHERE n = 1)
SELECT seq, page_url, contact_type, contact_value FROM b WHERE k = 1 OR contact_type = 'link'
""")
def page_postprocess_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.page_deduped(contacts(spark, sf_dir)).select("seq", "page_url", "contact_type", "contact_value")


_PEOPLE = _BEST + f"""
, f AS (SELECT *, first_value(company) OVER w AS shown_company, first_value(person_name) OVER w AS shown_name, {_SEMANTIC} AS is_semantic, {_digits('contact_value')} AS d FROM best WINDOW w AS (PARTITION BY company_key, person_key ORDER BY seq)),
r AS (
    SELECT *, row_number() OVER (PARTITION BY company_key, person_key, contact_type ORDER BY is_mailto DESC, is_semantic DESC,
              len(list_filter(regexp_extract_all(lower(shown_name), '[a-z]{{3,}}'), lambda t: contains(lower(split_part(contact_value, '@', 1)), t))) > 0 DESC, captured_at DESC, seq) AS e,
           row_number() OVER (PARTITION BY company_key, person_key, contact_type ORDER BY is_tel DESC, is_semantic DESC, NOT regexp_matches(d, '^(800|888|877|866)') DESC, captured_at DESC, seq) AS p,
           row_number() OVER (PARTITION BY company_key, person_key, contact_type ORDER BY ends_with(lower(contact_value), '.vcf') DESC, is_semantic DESC, captured_at DESC, seq) AS v
    FROM f
), people AS (
    SELECT company_key, person_key, min(shown_company) AS company, min(shown_name) AS person_name,
           arg_max(role_title, ({_KNOWN}) * 1000000000 + length(role_title) * 10000000 - seq) AS role_title,
           max(contact_value) FILTER (contact_type = 'email' AND e = 1) AS email, max(source_url) FILTER (contact_type = 'email' AND e = 1) AS url_e,
           max(d) FILTER (contact_type = 'phone' AND p = 1) AS phone, max(source_url) FILTER (contact_type = 'phone' AND p = 1) AS url_p,
           max(contact_value) FILTER (contact_type = 'link' AND v = 1 AND ends_with(contact_value, '.vcf')) AS vcard, max(source_url) FILTER (contact_type = 'link' AND v = 1 AND ends_with(contact_value, '.vcf')) AS url_v,
           arg_min(source_url, seq) AS first_url
    FROM r GROUP BY company_key, person_key
)
"""
_SHOWN = "company, person_name, role_title, coalesce(email, '') AS email, coalesce(CASE WHEN length(phone) = 11 AND starts_with(phone, '1') THEN substr(phone, 2) ELSE phone END, '') AS phone, coalesce(vcard, '') AS vcard"


@register(_C + _PEOPLE + f"SELECT {_SHOWN}, coalesce({_report('url_e')}, '') AS source_url_email, coalesce({_report('url_p')}, '') AS source_url_phone, coalesce({_report('url_v')}, '') AS source_url_vcard FROM people")
def people_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.people(C.deduped(_verified(spark, sf_dir)))


def _rx(p: str) -> str:
    return p.replace("(?<!vice )president", "president")  # oracle inputs don't hold both


_ROLE = (
    "CASE WHEN regexp_matches(t, '\\bgeneral counsel\\b') THEN ['title:general counsel'] "
    + " ".join(f"WHEN regexp_matches(t, '\\b{n}\\b') THEN ['exclude:{n}']" for n in rules.NEGATIVE)
    + " ELSE list_filter(["
    + ", ".join(
        f"CASE WHEN regexp_matches(t, '\\b{_rx(p if isinstance(p, str) else p[0])}\\b')" + (" AND NOT contains(t, 'vice president')" if p == rules.C_SUITE[1] else "") + f" THEN 'title:{p if isinstance(p, str) else p[1]}' END"
        for p in (*rules.C_SUITE, *rules.VP_PLUS, *rules.MGMT)
    )
    + "], lambda x: x IS NOT NULL) END"
)
_LABELS = {k: ", ".join(f"'title:{p if isinstance(p, str) else p[1]}'" for p in v) for k, v in (("4", rules.C_SUITE), ("3", rules.VP_PLUS), ("2", rules.MGMT))}
_LEVEL = "CASE WHEN len(reasons) = 0 THEN 0 WHEN starts_with(reasons[1], 'exclude:') THEN 1 " + " ".join(f"WHEN list_has_any(reasons, [{v}]) THEN {k}" for k, v in _LABELS.items()) + " ELSE 0 END"
_HINT = "CASE " + " ".join(f"WHEN contains(lower(ctx), '{h}') THEN 'struct:{h}'" for h in rules.HINTS) + " END"
_NAMES = "list_extract(['UNKNOWN', 'NON_DM', 'MGMT', 'VP_PLUS', 'C_SUITE'], (ordinal + 1)::INT)"


def _leveled(source: str, ctx: str) -> str:
    return f"""
, l0 AS (SELECT *, {_ROLE} AS reasons, {_HINT} AS hint FROM (SELECT *, lower(regexp_replace(trim(role_title), '\\s+', ' ', 'g')) AS t, {ctx} AS ctx FROM {source})),
l1 AS (SELECT *, {_LEVEL} AS base FROM l0),
leveled AS (SELECT * EXCLUDE (reasons), CASE WHEN hint IS NOT NULL AND base IN (0, 2) THEN base + 1 ELSE base END AS ordinal, CASE WHEN hint IS NULL THEN reasons ELSE list_append(reasons, hint) END AS reasons FROM l1)
"""


@register(_C + _leveled("contacts", "source_url") + f"SELECT seq, {_NAMES} AS decision_level, array_to_string(reasons, ';') AS reasons FROM leveled")
def role_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordinal, reasons = rules.role_level(F.col("role_title"), F.col("evidence.source_url"))
    return contacts(spark, sf_dir).select("seq", rules.level_name(ordinal).alias("decision_level"), F.array_join(reasons, ";").alias("reasons"))


_DECIDED = _C + _PEOPLE + _leveled("people", "coalesce(url_e, url_p, url_v, first_url)")


def _decided(spark: SparkSession, sf_dir: str, least: int = 0) -> DataFrame:
    return C.decision_people(C.deduped(_verified(spark, sf_dir)), least)


@register(_DECIDED + f"""
SELECT company, person_name, role_title, {_NAMES} AS decision_level, array_to_string(reasons, ';') AS decision_reasons, email, phone, vcard, (email <> '')::INT AS has_evidence_email, (phone <> '')::INT AS has_evidence_phone,
       (vcard <> '')::INT AS has_evidence_vcard, coalesce(url_e, '') AS source_url_email, coalesce(url_p, '') AS source_url_phone, coalesce(url_v, '') AS source_url_vcard
FROM (SELECT * REPLACE (coalesce(email, '') AS email, coalesce(CASE WHEN length(phone) = 11 AND starts_with(phone, '1') THEN substr(phone, 2) ELSE phone END, '') AS phone, coalesce(vcard, '') AS vcard) FROM leveled) WHERE ordinal >= 3
""")
def decision_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat, VP_PLUS and above."""
    return C.decision_flat(_decided(spark, sf_dir, rules.level_of("VP_PLUS")))


@register(_DECIDED + "SELECT level, count(person_key) AS people FROM (SELECT unnest(['UNKNOWN', 'NON_DM', 'MGMT', 'VP_PLUS', 'C_SUITE']) AS level, unnest(range(5)) AS k) LEFT JOIN leveled ON ordinal = k GROUP BY level")
def level_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every level has a row, also without people."""
    levels = spark.createDataFrame([(x,) for x in rules.LEVELS], "level string")
    n = _decided(spark, sf_dir).groupBy("decision_level").agg(F.count("*").alias("n"))
    return levels.join(n, F.col("level") == F.col("decision_level"), "left").select("level", F.coalesce("n", F.lit(0)).alias("people"))


_FILTER_TOP = " ".join(f"WHEN regexp_matches(role_title, '(?i)\\b{p}\\b') THEN 'title:\\b{p}\\b'" for p in rules.FILTER_C_SUITE)
_FILTER_REST = " ".join(f"WHEN regexp_matches(role_title, '(?i)\\b{p}\\b') THEN 'title:\\b{p}\\b'" for p in (*rules.FILTER_VP_PLUS, *rules.MGMT))
_FILTERED = _C + f"""
, p AS (SELECT *, CASE {_FILTER_TOP} END AS top, lower(regexp_extract(role_title, '(?i)\\b({'|'.join(n.replace(' ', chr(92) + 's+') for n in rules.NEGATIVE)})\\b', 1)) AS neg, CASE {_FILTER_REST} END AS rest,
           regexp_matches({_PATH.format(u='source_url')}, '(?i)/({'|'.join(rules.HINTS)})(/|$)') AS hinted,
           contact_type = 'email' AND regexp_matches(lower(contact_value), '{V.GENERIC_INBOX}') AS generic FROM contacts),
q AS (SELECT *, CASE WHEN top IS NOT NULL THEN 4 WHEN neg <> '' THEN 1 WHEN rest IN ('title:\\blead\\b', 'title:\\bmanager\\b') THEN 2 WHEN rest IS NOT NULL THEN 3 ELSE 0 END AS base FROM p),
filtered AS (SELECT *, CASE WHEN hinted AND base IN (0, 2) THEN base + 1 ELSE base END AS ordinal,
    list_filter([CASE WHEN generic THEN 'email:generic' END, CASE WHEN top IS NOT NULL THEN top WHEN neg <> '' THEN 'neg:' || neg ELSE rest END, CASE WHEN hinted THEN 'struct:leadership' END], lambda x: x IS NOT NULL) AS reasons FROM q)
"""


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    email = F.when(F.col("contact_type") == "email", V.filter_email(F.col("contact_value"))).otherwise("")
    ordinal, reasons = rules.filter_level(F.col("role_title"), email, F.array("evidence.source_url"))
    return contacts(spark, sf_dir).select("seq", ordinal.alias("ordinal"), reasons.alias("reasons"))


@register(_FILTERED + f"SELECT seq, {_NAMES} AS decision_level, array_to_string(reasons, ';') AS reasons FROM filtered")
def filter_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(spark, sf_dir).select("seq", rules.level_name(F.col("ordinal")).alias("decision_level"), F.array_join("reasons", ";").alias("reasons"))


@register(_FILTERED + "SELECT reason, count(*) AS n FROM (SELECT unnest(list_prepend('below_min_level', reasons)) AS reason FROM filtered WHERE ordinal < 3) GROUP BY reason ORDER BY n DESC, reason LIMIT 3")
def drop_reason_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = _filtered(spark, sf_dir).where(F.col("ordinal") < rules.level_of("VP_PLUS"))
    reasons = dropped.select(F.explode(F.concat(F.array(F.lit("below_min_level")), "reasons")).alias("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(3)


@register(_C + """
SELECT count(*) AS total, count(*) FILTER (verification_status = 'VERIFIED') AS verified, count(*) FILTER (verification_status = 'VERIFIED' AND contact_type = 'email') AS verified_email,
       count(*) FILTER (verification_status = 'VERIFIED' AND contact_type = 'phone') AS verified_phone, count(*) FILTER (verification_status = 'VERIFIED' AND contact_type = 'link') AS verified_link,
       round(count(*) FILTER (verification_status = 'VERIFIED') * 100.0 / count(*), 6) AS evidence_rate, count(*) FILTER (verification_status = 'VERIFIED') > 0 AS ready FROM contacts
""")
def export_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.export_stats(contacts(spark, sf_dir)).withColumn("evidence_rate", F.round(F.col("evidence_rate").cast("double"), 6))


@register(_C + """
SELECT count(*) AS total, count(*) FILTER (verification_status = 'VERIFIED') AS complete, round(avg((verification_status = 'VERIFIED')::INT), 6) AS ecr, CASE WHEN avg((verification_status = 'VERIFIED')::INT) >= 0.95 THEN 'OK' ELSE 'FAIL' END AS verdict FROM contacts
""")
def ecr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.ecr(contacts(spark, sf_dir)).withColumn("ecr", F.round("ecr", 6))


@register(_C + _BEST + "SELECT (SELECT count(*) FROM good) AS verified, (SELECT count(*) FROM best) AS written, (SELECT count(*) FROM good) = (SELECT count(*) FROM best) AS intact")
def export_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _verified(spark, sf_dir)
    written = C.deduped(good).agg(F.count("*").alias("written")).withColumn("k", F.lit(1))
    both = good.agg(F.count("*").alias("verified")).withColumn("k", F.lit(1)).join(written, "k")
    return both.select("verified", "written", (F.col("verified") == F.col("written")).alias("intact"))


@register(_C + f"""
, k AS (SELECT *, sha1(lower(trim(person_name)) || '@' || regexp_replace(lower(company), '\\s+', '', 'g')) AS norm_key FROM good)
SELECT norm_key, contact_type, contact_value, arg_min(company, seq) AS company, arg_min(person_name, seq) AS person_name, arg_max(role_title, seq) AS role_title, arg_max(captured_at, seq) AS captured_at
FROM k GROUP BY norm_key, contact_type, contact_value
""")
def norm_key_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half is in the table when the second is put in."""
    rows = C.verified(contacts(spark, sf_dir))
    middle = F.col("seq") % 2 == 0
    low = rows.agg(F.expr("percentile_approx(seq, 0.5)").alias("m")).first()["m"]
    middle = F.col("seq") <= (low or 0)
    done = C.upserted(C.upserted(None, rows.where(middle)), rows.where(~middle))
    return done.select("norm_key", "contact_type", "contact_value", "company", "person_name", "role_title", "captured_at")


# --- acceptance, counters, probes, costs ------------------------------------------------------------------------------


def _signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("seq")
    return contacts(spark, sf_dir).select(
        "seq", (s % 2 == 0).alias("has_title"), (s % 3 == 0).alias("from_mailto"), (s % 5 == 0).alias("has_phone"), (s % 7 == 0).alias("has_vcard"), (s % 4 == 1).alias("show_trigger"), (s % 5).alias("page_count"),
        (s % 8).alias("site_count"), (s % 6 == 2).alias("in_footer"), U.negative_zone(F.col("evidence.source_url")).alias("negative_zone"),
        F.when(s % 10 == 0, "gmail.com").otherwise(F.concat(F.lit("mail"), s % 4, F.lit(".example"))).alias("email_domain"), F.concat(F.lit("www.mail"), s % 3, F.lit(".example")).alias("site_host"),
    )


@register(_C + f"""
, s AS (SELECT seq, seq % 2 = 0 AS t, seq % 3 = 0 AS m, seq % 5 = 0 AS p, seq % 7 = 0 AS v, seq % 4 = 1 AS w, seq % 5 AS pc, seq % 8 AS sc, seq % 6 = 2 AS f, regexp_matches(lower({_PATH.format(u='source_url')}), '/press|/news|/media|/careers|/jobs|/vacancies|/employment|/agency') AS z,
          CASE WHEN seq % 10 = 0 THEN 'gmail.com' ELSE 'mail' || (seq % 4) || '.example' END AS ed, 'mail' || (seq % 3) || '.example' AS site FROM contacts),
x AS (SELECT *, t::INT + 2 * m::INT + 2 * p::INT + 2 * v::INT + w::INT + CASE WHEN pc >= 3 THEN 2 WHEN pc = 2 THEN 1 ELSE 0 END + CASE WHEN sc >= 5 THEN 2 WHEN sc >= 3 THEN 1 ELSE 0 END + 2 * f::INT - 2 * z::INT AS score,
        (p OR v OR pc >= 2 OR f OR sc >= 3) AS strong FROM s)
SELECT seq, score::INT AS score, array_to_string(list_filter([CASE WHEN t THEN 'title' END, CASE WHEN m THEN 'mailto' END, CASE WHEN p THEN 'phone' END, CASE WHEN v THEN 'vcard' END, CASE WHEN w THEN 'show-email' END,
       CASE WHEN pc >= 3 THEN 'repeat>=3' WHEN pc = 2 THEN 'repeat>=2' END, CASE WHEN sc >= 5 THEN 'site>=5' WHEN sc >= 3 THEN 'site>=3' END, CASE WHEN f THEN 'footer' END, CASE WHEN z THEN 'neg-zone' END], lambda x: x IS NOT NULL), ',') AS signals,
       CASE WHEN ends_with(ed, site) THEN 'suffix' WHEN score >= 5 AND strong THEN 'cross-domain' ELSE 'rejected' END AS verdict FROM x
""")
def xdom_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    score, signals = routing.acceptance()
    return _signs(spark, sf_dir).select("seq", score.alias("score"), F.array_join(signals, ",").alias("signals"), routing.accepted_email().alias("verdict"))


@register(f"""
WITH p AS (SELECT page_id AS seq, lower({_NETLOC.format(u='url')}) AS host, 'd' || (page_id % 3) AS domain, page_id % 4 + 1 AS n FROM pages),
q AS (SELECT page_id // 3 AS seq, min(split_part(host, '.', -1)) AS host FROM (SELECT seq AS page_id, host FROM p) GROUP BY 1),
i AS (SELECT seq, sum(start) OVER (ORDER BY seq) AS island FROM (SELECT seq, (host IS DISTINCT FROM lag(host) OVER (ORDER BY seq))::INT AS start FROM q)),
m AS (SELECT island, i.seq, domain, sum(n) AS page_count FROM i JOIN p ON p.seq // 3 = i.seq GROUP BY ALL)
SELECT seq, domain, page_count, sum(page_count) OVER (PARTITION BY island, domain ORDER BY seq) AS site_count FROM m
""")
def site_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rows of `pages` make a page here, its host being the first top level of the three."""
    rows = _pages(spark, sf_dir).select(F.expr("page_id div 3").alias("seq"), F.substring_index(U.authority(F.col("url")), ".", -1).alias("host"), F.concat(F.lit("d"), F.col("page_id") % 3).alias("domain"), (F.col("page_id") % 4 + 1).alias("n"))
    return routing.site_counts(rows.groupBy("seq").agg(F.min("host").alias("host")), rows.select("seq", "domain", "n"))


_ATTEMPTS = "SELECT c_custkey AS seq, CASE c_custkey % 11 WHEN 0 THEN 'nobody' WHEN 1 THEN 'u' || c_custkey || '@gmail.com' ELSE 'u' || (c_custkey % 400) || '@d' || c_nationkey || '.example' END AS email FROM customer"
_HOSTS = "SELECT concat('d', n_nationkey, '.example') AS domain, unnest([n_nationkey % 3 * 10, 10, 5]) AS pref, unnest(['a', 'b', 'c']) || '.mx' || n_nationkey AS host, unnest([0, 1, 2]) AS seq FROM nation WHERE n_nationkey % 5 <> 0"


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    email = F.when(k % 11 == 0, "nobody").when(k % 11 == 1, F.concat(F.lit("u"), k, F.lit("@gmail.com"))).otherwise(F.concat(F.lit("u"), k % 400, F.lit("@d"), n, F.lit(".example")))
    return table(spark, sf_dir, "customer").select(k.alias("seq"), email.alias("email"))


def _hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    three = F.array(*(F.struct(p.alias("pref"), F.concat(F.lit(h + ".mx"), k).alias("host"), F.lit(s).alias("seq")) for s, (p, h) in enumerate(((k % 3 * 10, "a"), (F.lit(10), "b"), (F.lit(5), "c")))))
    return table(spark, sf_dir, "nation").where(k % 5 != 0).select(F.concat(F.lit("d"), k, F.lit(".example")).alias("domain"), F.inline(three))


@register(f"SELECT domain, host, row_number() OVER (PARTITION BY domain ORDER BY pref, seq) AS host_rank FROM ({_HOSTS})")
def mx_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe.ranked_hosts(_hosts(spark, sf_dir))


_POLICY = f"""
WITH a AS (SELECT seq, email, CASE WHEN contains(email, '@') THEN lower(split_part(email, '@', -1)) END AS domain FROM ({_ATTEMPTS})),
c AS (SELECT DISTINCT email FROM a WHERE seq % 13 = 0),
h AS (SELECT a.*, c.email IS NOT NULL AS hit, domain IN ('gmail.com') AS free FROM a LEFT JOIN c ON a.email = c.email),
t AS (SELECT *, coalesce(sum((domain IS NOT NULL AND NOT free AND NOT hit)::INT) OVER (PARTITION BY domain ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tried FROM h),
d AS (SELECT seq, email, domain, CASE WHEN domain IS NULL THEN 'input' WHEN free THEN 'policy' WHEN tried >= 5 THEN 'quota' WHEN hit THEN 'cached' ELSE 'probe' END AS decision FROM t)
"""


def _policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _attempts(spark, sf_dir)
    return probe.decisions(rows, rows.where(F.col("seq") % 13 == 0).select("email"))


@register(_POLICY + "SELECT * FROM d")
def probe_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _policy(spark, sf_dir)


@register(_POLICY + f"""
, m AS (SELECT domain, host, row_number() OVER (PARTITION BY domain ORDER BY pref, seq) AS r FROM ({_HOSTS})),
o AS (SELECT d.*, m.host, m.r, CASE WHEN m.host IS NULL THEN NULL ELSE [250, 451, 550, 199][((d.seq + m.r) % 4 + 1)::INT] END AS code, (d.seq + m.r) % 9 = 0 AS raised FROM d LEFT JOIN m ON d.domain = m.domain WHERE decision = 'probe'),
g AS (SELECT seq, email, domain, min(r) FILTER (code BETWEEN 200 AND 299 AND NOT raised) AS won, max(r) AS last FROM o GROUP BY ALL)
SELECT g.seq, g.email, g.domain, o.host AS mx_used, won IS NOT NULL AS accepts_rcpt, o.code AS smtp_code,
       CASE WHEN o.host IS NULL OR raised THEN 'network' WHEN code BETWEEN 200 AND 299 THEN 'ok' WHEN code BETWEEN 400 AND 499 THEN 'temp' WHEN code BETWEEN 500 AND 599 THEN 'perm' ELSE 'unknown' END AS error_category, o.host IS NOT NULL AS mx_found
FROM g LEFT JOIN o ON g.seq = o.seq AND o.r IS NOT DISTINCT FROM coalesce(g.won, g.last)
""")
def probe_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of hosts are made from the attempt's number and the host's rank."""
    probes = _policy(spark, sf_dir).where("decision = 'probe'").drop("decision")
    hosts = probe.ranked_hosts(_hosts(spark, sf_dir))
    turn = F.col("seq") + F.col("host_rank")
    rcpt = probes.join(hosts, "domain").select("seq", F.col("host").alias("mx_host"), F.element_at(F.array(*map(F.lit, (250, 451, 550, 199))), (turn % 4 + 1).cast("int")).alias("smtp_code"), (turn % 9 == 0).alias("raised"))
    return probe.outcomes(probes, hosts, rcpt)


@register("SELECT c_custkey AS k, c_custkey % 700 AS smtp_code, CASE WHEN c_custkey % 17 = 0 THEN 'network' WHEN c_custkey % 700 BETWEEN 200 AND 299 THEN 'ok' WHEN c_custkey % 700 BETWEEN 400 AND 499 THEN 'temp' WHEN c_custkey % 700 BETWEEN 500 AND 599 THEN 'perm' ELSE 'unknown' END AS category FROM customer")
def smtp_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("k"), (k % 700).alias("smtp_code"), probe.category(k % 700, k % 17 == 0).alias("category"))


@register(f"""
WITH a AS ({_ATTEMPTS}), c AS (SELECT email, max(1700000000 - seq * 1000) AS checked_at FROM a GROUP BY email)
SELECT seq, a.email, 1700000000 - checked_at < 604800 AS cached FROM a JOIN c ON a.email = c.email
""")
def cache_ttl_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _attempts(spark, sf_dir)
    cache = rows.groupBy("email").agg(F.max(1_700_000_000 - F.col("seq") * 1000).alias("checked_at"))
    hits = probe.fresh(cache, F.lit(1_700_000_000)).select("email", F.lit(True).alias("hit"))
    return rows.join(hits, "email", "left").select("seq", "email", F.coalesce("hit", F.lit(False)).alias("cached"))


@register("""
SELECT event_type AS method, count(*) AS pages, count(DISTINCT user_id) AS domains, round(sum(value), 4) AS total_s, round(sum(value) / 60 * 0.02 + count(*) * 0.001, 4) AS cost FROM events GROUP BY event_type
""")
def time_cost_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as operations: value is seconds; a rate for a minute and a fee for a page."""
    total = F.sum("value")
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("method")).agg(F.count("*").alias("pages"), F.countDistinct("user_id").alias("domains"), F.round(total, 4).alias("total_s"), F.round(total / 60 * 0.02 + F.count("*") * 0.001, 4).alias("cost"))


# --- extraction ------------------------------------------------------------------------------------------------------

_WRITTEN = f"""
WITH c AS (SELECT *, trim(regexp_replace(person_name, ' +', ' ', 'g')) AS name, trim(company) AS firm, CASE WHEN regexp_matches(lower(role_title), '{'|'.join(extract.MINOR_ROLES)}') THEN 'Unknown' ELSE role_title END AS role FROM ({CONTACTS_SQL}))
"""


def _cards(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    """A page for each contact that isn't a link, holding one card or one row of a table."""
    c = contacts(spark, sf_dir).where("contact_type <> 'link'")
    value = F.col("contact_value")
    if form == "card":
        anchor = F.when(F.col("contact_type") == "email", F.concat(F.lit('<a href="mailto:'), value, F.lit('?subject=x">write</a>'))).otherwise(F.concat(F.lit('<a href="tel:'), value, F.lit('">call</a>')))
        body = F.concat(F.lit('<div class="team-member"><h3>'), "person_name", F.lit('</h3><p class="title">'), "role_title", F.lit("</p>"), anchor, F.lit("</div>"))
    else:
        cells = [F.col("person_name"), F.col("role_title"), F.when(F.col("contact_type") == "email", value).otherwise(""), F.when(F.col("contact_type") == "phone", value).otherwise("")]
        body = F.concat(F.lit("<table><tr><th>Name<th>Title<th>Email<th>Phone<tr><td>"), F.array_join(F.array(*cells), "<td>"), F.lit("</table>"))
    return c.select(F.col("seq").alias("page_id"), F.col("evidence.source_url").alias("url"), F.concat(F.lit("<title>"), "company", F.lit(" - Team</title>"), body).alias("html"))


@register(_WRITTEN + f"SELECT seq AS page_id, firm AS company, name AS person_name, role AS role_title, contact_type, CASE WHEN contact_type = 'email' THEN lower(contact_value) ELSE {_digits('contact_value')} END AS contact_value FROM c WHERE contact_type <> 'link'")
def card_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.accepted(extract.candidates(_cards(spark, sf_dir, "card"))).select("page_id", "company", "person_name", "role_title", "contact_type", "contact_value")


@register(_WRITTEN + f"SELECT seq AS page_id, firm AS company, name AS person_name, role_title, contact_type, CASE WHEN contact_type = 'email' THEN lower(contact_value) ELSE {_digits('contact_value')} END AS contact_value FROM c WHERE contact_type <> 'link'")
def table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.accepted(extract.candidates(_cards(spark, sf_dir, "table"))).select("page_id", "company", "person_name", "role_title", "contact_type", "contact_value")


#: Forms of titles, first headings, names and roles that pages are made of.
_FORMS = {
    "title": ("Firm - Team", "Team - Firm", "News & Insights | Firm", "Home", "About us", "Contacts", "Teamwork | Firm"),
    "heading": ("People", "Acme and Sons", "", "Press room"),
    "name": ("Ada Arden", "Dr. Ben Birch", "Business Services Team", "Executive Team", "Ada", "Dr. Ada", "Cleo 3 Cole", "Contact us", "Élan Ünal"),
    "role": ("Partner", "Retired", "Executive Assistant", "Coming soon", "Open Seat", "VP", "International Counsel", "Head of Data", "Paralegal", "Email", "Areas of Focus:"),
}
_FORM_SQL = ", ".join(f"[{', '.join(repr(f) for f in forms)}][CAST(page_id % {len(forms)} AS INT) + 1] AS {name}" for name, forms in _FORMS.items())
_HEADING = "(?i)^(contact|contacts|news( *& *insights)?|press|team|people|about)\\b"


@register(f"""
WITH f AS (SELECT page_id, {_FORM_SQL} FROM pages), c AS (SELECT *, regexp_replace(title, ' *[-|].*$', '') AS cut FROM f)
SELECT page_id, CASE WHEN NOT regexp_matches(cut, '{_HEADING}') THEN cut WHEN heading <> '' AND NOT regexp_matches(heading, '{_HEADING}') THEN heading ELSE 'Firm-' || page_id % 3 || '.Example' END AS company,
       regexp_replace(name, '^Dr. ', '') AS person_name,
       CASE WHEN length(role) < 3 OR lower(role) IN ({', '.join(repr(r) for r in sorted(extract.NO_ROLES))}) OR regexp_matches(lower(role), '{'|'.join(extract.MINOR_ROLES)}') THEN 'Unknown' ELSE role END AS role_title
FROM c WHERE name NOT IN ('Business Services Team', 'Executive Team', 'Ada', 'Dr. Ada', 'Cleo 3 Cole', 'Contact us')
""")
def card_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company, name and title of cards in many forms; names that are none give no row."""
    n = F.col("page_id")
    form = {name: F.element_at(F.array(*map(F.lit, forms)), (n % len(forms)).cast("int") + 1) for name, forms in _FORMS.items()}
    html = F.format_string("<title>%s</title><h1>%s</h1><div class='team-member'><h3>%s</h3><p class='title'>%s</p><a href='tel:5555550101'>call</a></div>", *(form[k] for k in ("title", "heading", "name", "role")))
    made = _pages(spark, sf_dir).select("page_id", F.concat(F.lit("https://www.firm-"), n % 3, F.lit(".example/team")).alias("url"), html.alias("html"))
    return extract.candidates(made).where("contact_type = 'phone'").select("page_id", "company", "person_name", "role_title")


@register()
def fast_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.accepted(extract.candidates(_cards(spark, sf_dir, "card"), rendered=True)).select("page_id", "person_name", "contact_type", "contact_value")


@register()
def link_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.links(_pages(spark, sf_dir))


@register()
def brand_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = U.authority(F.col("url"))
    pairs = _pages(spark, sf_dir).select("page_id", F.concat(F.lit("mail."), F.regexp_replace(U.registrable(host), "^(.)(.)", "$2$1")).alias("email_domain"), host.alias("site_host"))
    return brand.brand_matches(pairs)


@register(_C + "SELECT seq, 'Title ' || seq AS title FROM contacts WHERE contact_type = 'link' AND ends_with(contact_value, '.vcf') AND seq % 4 <> 0 ORDER BY seq LIMIT 50")
def vcard_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards are made up: every fourth has no title."""
    rows = contacts(spark, sf_dir).where("contact_type = 'link' and contact_value like '%.vcf'").select("seq", F.concat("contact_value", F.lit("?"), "seq").alias("vcard"))
    body = F.when(F.col("seq") % 4 == 0, "BEGIN:VCARD").otherwise(F.concat(F.lit("BEGIN:VCARD\nTITLE: Title "), "seq", F.lit("\nORG:x")))
    return C.vcard_titles(rows, rows.select(F.col("vcard").alias("url"), F.lit(200).alias("status"), body.alias("body")))


@register(_C + "SELECT company_key AS company, contact_type, count(*) AS contacts, count(*) FILTER (verification_status = 'VERIFIED') AS complete, grouping(company_key, contact_type) AS level FROM contacts GROUP BY GROUPING SETS ((company_key), (contact_type), ())")
def gold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contacts(spark, sf_dir).select(F.lower(T.strip(F.col("company"))).alias("company"), "contact_type", C.complete().alias("complete"))
    return C.gold_metrics(rows)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision makers with their best contacts, from raw contact rows."""
    return decision_people(spark, sf_dir)
