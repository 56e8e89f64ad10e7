"""The contact relation: validation, verification, dedupe, one row for each person, decision makers, statistics, upsert.

A contact is a row (seq, company, person_name, role_title, contact_type, contact_value, evidence, captured_at); `seq` is its
place in the input and settles what is equal otherwise: the first wins. All of it is columns, windows and aggregates: each
step is one shuffle by its key, with partial aggregation where the result allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import contact_values as V
from ..functions.text import blank, digits, flagged, person_key, strip
from ..functions.urls import for_report, semantic
from .rules import level_name, role_level

EVIDENCE_TEXTS = ("source_url", "selector_or_xpath", "verbatim_quote", "dom_node_screenshot", "parser_version", "content_hash")
#: What in a name says that it is no person's. Fixed values.
NOT_PERSONS = ("mailing address", "click here", "branch hours", "business services team", "executive team", "support", "department", "services", "contact us", "resources")


def complete(evidence: str = "evidence") -> Column:
    """Six texts not blank, and a timestamp."""
    test = F.col(f"{evidence}.timestamp").isNotNull()
    for name in EVIDENCE_TEXTS:
        test = test & ~blank(F.col(f"{evidence}.{name}"))
    return F.coalesce(test, F.lit(False))


def violations() -> Column:
    """Names of the broken rules of a row, in a fixed order; empty for a valid one."""
    value, kind, e = F.col("contact_value"), F.col("contact_type"), "evidence."
    rules = [
        (blank(F.col("company")), "company"),
        (blank(F.col("person_name")), "person_name"),
        (~F.coalesce(kind.isin("email", "phone", "link"), F.lit(False)), "contact_type"),
        ((kind == "email") & ~F.coalesce(value.rlike(r"^[^@]+@[^@]+\.[^@]+$"), F.lit(False)), "email"),
        ((kind == "phone") & ~F.coalesce(F.regexp_replace(value, r"[\s\-().+]", "").rlike(r"^\d{7,15}$"), F.lit(False)), "phone"),
        ((kind == "link") & ~F.coalesce(value.rlike("^https?://"), F.lit(False)), "link"),
        (~F.coalesce(F.col(e + "source_url").rlike("^https?://"), F.lit(False)), "source_url"),
        (~F.coalesce(F.lower(e + "content_hash").rlike("^[0-9a-f]{64}$"), F.lit(False)), "content_hash"),
        (~F.coalesce(F.col(e + "parser_version").rlike(r"^\d+\.\d+\.\d+(-[a-zA-Z0-9]+)?$"), F.lit(False)), "parser_version"),
    ]
    return flagged(rules)


def validated(contacts: DataFrame) -> DataFrame:
    """All rows with `violations` and the derived `verification_status`; names trimmed, hashes lower-cased."""
    made = contacts.withColumn("violations", violations()).withColumn("verification_status", F.when(complete(), "VERIFIED").otherwise("UNVERIFIED"))
    made = made.withColumns({"company": strip(F.col("company")), "person_name": strip(F.col("person_name"))})
    return made.withColumn("evidence", F.col("evidence").withField("content_hash", F.lower("evidence.content_hash")))


def verified(contacts: DataFrame) -> DataFrame:
    return validated(contacts).where((F.size("violations") == 0) & (F.col("verification_status") == "VERIFIED"))


def iso(ts: Column) -> Column:
    """Like isoformat() in UTC: microseconds only where there are any."""
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def flat(contacts: DataFrame) -> DataFrame:
    """The 14 columns of an export, in their order."""
    names = ("source_url", "selector_or_xpath", "verbatim_quote", "dom_node_screenshot")
    return contacts.select(
        "company", "person_name", "role_title", "contact_type", "contact_value", iso(F.col("captured_at")).alias("captured_at"), "verification_status",
        for_report(F.col("evidence.source_url")).alias("source_url"), *(F.col(f"evidence.{n}") for n in names[1:]), iso(F.col("evidence.timestamp")).alias("timestamp"), "evidence.parser_version", "evidence.content_hash",
    )


def _anchor(kind: str) -> Column:
    return F.coalesce(F.lower("evidence.selector_or_xpath").contains(f"a[href*='{kind}:']"), F.lit(False)).cast("int")


def _known(role: Column) -> Column:
    return F.coalesce((~blank(role)) & (F.lower(strip(role)) != "unknown"), F.lit(False)).cast("int")


def _semantic() -> Column:
    return semantic(F.col("evidence.source_url")).cast("int")


def value_key() -> Column:
    return F.when(F.col("contact_type") == "phone", digits(F.col("contact_value"))).otherwise(F.lower(strip(F.col("contact_value"))))


def keyed(contacts: DataFrame) -> DataFrame:
    return contacts.withColumns({"company_key": F.lower(strip(F.col("company"))), "person_key": person_key(F.col("person_name"))})


def deduped(contacts: DataFrame) -> DataFrame:
    """The best row of each (company, person, type, value): link over text, people page, known role, short URL, fresh. It
    takes the place (seq) of the first row of its key. One aggregation: partial in every task, then by key."""
    quality = F.struct(
        F.greatest(_anchor("mailto"), _anchor("tel")).alias("anchor"), _semantic().alias("semantic"), _known(F.col("role_title")).alias("role"),
        (-F.length(F.coalesce(for_report(F.col("evidence.source_url")), F.lit("")))).alias("short"), F.col("captured_at").alias("fresh"), (-F.col("seq")).alias("first"),
    )
    rows = keyed(contacts).withColumn("value_key", value_key())
    whole = F.struct(*(F.col(c) for c in contacts.columns))
    best = rows.groupBy("company_key", "person_key", "contact_type", "value_key").agg(F.max_by(whole, quality).alias("row"), F.min("seq").alias("place"))
    return best.select(*(F.col("place").alias("seq") if c == "seq" else F.col(f"row.{c}") for c in contacts.columns))


def page_deduped(contacts: DataFrame) -> DataFrame:
    """Within a page's contacts: the best row of each value (link over text, then known role), then one e-mail and one phone
    for each person; all links stay."""
    quality = [F.greatest(_anchor("mailto"), _anchor("tel")).desc(), _known(F.col("role_title")).desc(), F.col("seq").asc()]
    keys = ["page_url", F.lower(strip(F.col("company"))), F.lower(strip(F.col("person_name"))), "contact_type"]
    value = value_key()
    once = contacts.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, value).orderBy(*quality))).where("_n = 1")
    one = once.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*quality)))
    return one.where("_n = 1 or contact_type = 'link'").drop("_n")


def _local_matches(email: Column, name: Column) -> Column:
    local = F.lower(F.substring_index(email, "@", 1))
    return F.exists(F.regexp_extract_all(F.lower(name), F.lit("[a-z]{3,}"), F.lit(0)), lambda token: local.contains(token)).cast("int")


def consolidated(contacts: DataFrame) -> DataFrame:
    """One row for each (company, person) with the best e-mail, phone, card and role, and the evidence of each.

    Display values are the first row's. The local part of an e-mail is held against that name, so it is found first (one
    window over the key) and the rest is one aggregation without another shuffle.
    """
    name = F.lower(strip(F.col("person_name")))
    people = keyed(contacts)
    for phrase in NOT_PERSONS:
        people = people.where(~F.coalesce(name.contains(phrase), F.lit(False)))
    first = Window.partitionBy("company_key", "person_key").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    people = people.withColumns({"shown_company": F.first("company").over(first), "shown_name": F.first("person_name").over(first)})
    kind, last = F.col("contact_type"), (-F.col("seq")).alias("first")
    tel, d = _anchor("tel"), digits(F.col("contact_value"))
    fields = F.struct("contact_value", "evidence")
    fresh = F.col("captured_at").alias("fresh")

    def best(when: Column, *rank: Column) -> Column:
        names = [c.alias(f"k{k}") for k, c in enumerate(rank)]
        return F.max_by(fields, F.when(when, F.struct(*names, fresh, last)))

    by = people.groupBy("company_key", "person_key").agg(
        F.min_by("shown_company", "seq").alias("company"),
        F.min_by("shown_name", "seq").alias("person_name"),
        best(kind == "email", _anchor("mailto"), _semantic(), _local_matches(F.col("contact_value"), F.col("shown_name"))).alias("e"),
        best((kind == "phone") & (tel == 1), _semantic(), V.not_toll_free(F.col("contact_value"))).alias("pa"),
        best((kind == "phone") & (tel == 0) & V.plausible_phone(d), _semantic(), V.not_toll_free(F.col("contact_value"))).alias("pt"),
        best((kind == "link") & F.lower("contact_value").endswith(".vcf"), _semantic()).alias("v"),
        F.max_by(strip(F.coalesce("role_title", F.lit("Unknown"))), F.struct(_known(F.col("role_title")).alias("k"), F.length(strip(F.coalesce("role_title", F.lit("")))).alias("n"), last)).alias("role"),
        F.max(_known(F.col("role_title"))).alias("any_role"),
        F.min_by("evidence.source_url", "seq").alias("first_url"),
    )
    quote = digits(F.col("pa.evidence.verbatim_quote"))
    shown = F.when(F.col("pa").isNotNull(), F.when(V.plausible_phone(quote), quote).otherwise(digits(F.col("pa.contact_value")))).otherwise(digits(F.col("pt.contact_value")))
    phone = F.coalesce("pa", "pt")
    return by.select(
        "company", "person_name", F.when(F.col("any_role") == 1, F.col("role")).otherwise("Unknown").alias("role_title"),
        F.coalesce("e.contact_value", F.lit("")).alias("email"), F.when(phone.isNull(), "").otherwise(V.without_country(shown)).alias("phone"), F.coalesce("v.contact_value", F.lit("")).alias("vcard"),
        F.col("e.evidence").alias("evidence_email"), phone["evidence"].alias("evidence_phone"), F.col("v.evidence").alias("evidence_vcard"), "first_url",
    )


def people(contacts: DataFrame) -> DataFrame:
    """The nine text columns of the people export; what is missing is empty."""
    rows = consolidated(contacts)
    urls = [F.coalesce(for_report(F.col(f"evidence_{k}.source_url")), F.lit("")).alias(f"source_url_{k}") for k in ("email", "phone", "vcard")]
    return rows.select("company", "person_name", "role_title", "email", "phone", "vcard", *urls)


def decision_people(contacts: DataFrame, least: int = 0) -> DataFrame:
    """People with their level, the reasons for it and the state of their evidence; those below `least` go."""
    rows = consolidated(contacts)
    kinds = [f"evidence_{k}" for k in ("email", "phone", "vcard")]
    url = F.coalesce(*(F.col(f"{k}.source_url") for k in kinds), F.col("first_url"))
    ordinal, reasons = role_level(F.col("role_title"), url)
    rows = rows.withColumns({"decision_ordinal": ordinal, "decision_reasons": reasons}).where(F.col("decision_ordinal") >= least)
    some, all_ = F.lit(False), F.lit(True)
    for k in kinds:
        some, all_ = some | F.col(k).isNotNull(), all_ & (F.col(k).isNull() | complete(k))
    rows = rows.withColumn("evidence_complete", some & all_).withColumn("decision_level", level_name(F.col("decision_ordinal")))
    return rows.withColumn("verification_status", F.when(F.col("evidence_complete"), "VERIFIED").otherwise("UNVERIFIED")).drop("first_url")


def decision_flat(rows: DataFrame) -> DataFrame:
    """The flat columns of the decision makers' export."""
    kinds = ("email", "phone", "vcard")
    has = [F.when(F.col(f"evidence_{k}").isNotNull() & complete(f"evidence_{k}"), 1).otherwise(0).alias(f"has_evidence_{k}") for k in kinds]
    urls = [F.coalesce(F.col(f"evidence_{k}.source_url"), F.lit("")).alias(f"source_url_{k}") for k in kinds]
    reasons = F.array_join("decision_reasons", ";").alias("decision_reasons")
    return rows.select("company", "person_name", "role_title", "decision_level", reasons, *kinds, *has, *urls)


def norm_key(name: Column, company: Column) -> Column:
    return F.sha1(F.concat(F.lower(strip(name)), F.lit("@"), F.regexp_replace(F.lower(company), r"(?U)\s+", "")))


def upserted(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The table after the batch is put in by (norm_key, contact_type, contact_value): id, company and name stay the first's,
    all else becomes the last's. Portable to tables without row-level updates: one aggregation over both."""
    keep = ("company", "person_name")
    renew = ("role_title", "verification_status", "captured_at", "evidence")
    new = batch.select(F.lit(1).alias("turn"), "seq", norm_key(F.col("person_name"), F.col("company")).alias("norm_key"), "contact_type", "contact_value", *keep, *renew)
    if target is not None:
        new = target.select(F.lit(0).alias("turn"), "seq", "norm_key", "contact_type", "contact_value", *keep, *renew).unionByName(new)
    order = F.struct("turn", "seq")
    aggregates = [F.min_by(c, order).alias(c) for c in keep] + [F.max_by(c, order).alias(c) for c in renew] + [F.min_by("seq", order).alias("seq")]
    return new.groupBy("norm_key", "contact_type", "contact_value").agg(*aggregates)


def export_stats(contacts: DataFrame) -> DataFrame:
    """One row: totals, verified rows by type, evidence rate in percent, whether there is anything to export."""
    c = validated(contacts)
    good = F.col("verification_status") == "VERIFIED"
    return c.agg(
        F.count("*").alias("total"), F.count_if(good).alias("verified"), *(F.count_if(good & (F.col("contact_type") == k)).alias(f"verified_{k}") for k in ("email", "phone", "link")),
        F.coalesce(F.count_if(good) * 100.0 / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("evidence_rate"), (F.count_if(good) > 0).alias("ready"),
    )


def ecr(contacts: DataFrame, threshold: float = 0.95) -> DataFrame:
    """One row: evidence completeness rate over all rows, and whether it reaches the threshold."""
    rate = F.coalesce(F.avg(complete().cast("double")), F.lit(0.0))
    return contacts.agg(F.count("*").alias("total"), F.count_if(complete()).alias("complete"), rate.alias("ecr"), F.when(rate >= threshold, "OK").otherwise("FAIL").alias("verdict"))


def vcard_titles(rows: DataFrame, vcards: DataFrame, budget: int = 50, most_bytes: int = 65_536) -> DataFrame:
    """Titles from cards: (seq, title) for the first `budget` rows, by seq, whose card gives one. rows: (seq, vcard); vcards:
    (url, status, body). A card that is too long or gives no title costs nothing. The budget is a top-k."""
    good = vcards.where((F.col("status") < 400) & (F.octet_length("body") <= most_bytes)).select(F.col("url").alias("vcard"), V.vcard_title(F.col("body")).alias("title"))
    return rows.select("seq", "vcard").join(good.where("title is not null"), "vcard").orderBy("seq").limit(budget).select("seq", "title")


def gold_metrics(gold: DataFrame) -> DataFrame:
    """Counts of gold contacts (company, contact_type, complete) by company, by type and over all, in one pass."""
    sets = gold.groupingSets([["company"], ["contact_type"], []], "company", "contact_type")
    return sets.agg(F.count("*").alias("contacts"), F.count_if("complete").alias("complete"), F.grouping_id().alias("level"))
