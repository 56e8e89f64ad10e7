"""The entry points as plans: fetched pages to exports, people files to decision makers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import contact_values as V
from ..functions import text as T
from ..functions import urls as U
from ..operators import contacts as C
from ..operators import extract, routing, rules
from ..sources import readers, writers
from .relations import PARSER_VERSION


@dataclass(frozen=True)
class Options:
    include_all: bool = False
    decision_only: bool = False
    min_level: str = "VP_PLUS"
    allow_free: bool = False
    ecr_threshold: float = 0.95


def contacts_of(fetches: DataFrame, rendered: DataFrame | None = None, allow_free: bool = False) -> DataFrame:
    """Contacts with whole evidence from fetches (page_id, url, status_code, mime, html, fetched_at, blocked_by_robots) and,
    where a page has reasons to be rendered, is a target and is granted by the budgets, from rendered (page_id, html) instead."""
    pages = fetches.where((F.col("status_code") < 400) & ~F.coalesce("blocked_by_robots", F.lit(False)) & (F.col("mime") == "text/html"))
    static = extract.accepted(extract.candidates(pages), allow_free=allow_free)
    if rendered is not None:
        html = F.col("html")
        reasons = rules.escalation_reasons(F.col("mime"), F.octet_length(html), html, rules.term_hits(html))
        wants = (F.size(reasons) > 0) & U.ingest_target(F.col("url"))
        asked = pages.select(F.col("page_id").alias("seq"), U.authority(F.col("url")).alias("domain"), wants.alias("wants"))
        granted = routing.headless_grants(asked).where("granted").select(F.col("seq").alias("page_id"))
        wanting = pages.join(granted, "page_id").select("page_id", "url")
        shown = extract.accepted(extract.candidates(wanting.join(rendered.select("page_id", "html"), "page_id").select("page_id", "url", "html"), rendered=True), allow_free=allow_free)
        done = shown.select("page_id").distinct()
        static = static.join(done, "page_id", "left_anti").unionByName(shown)
    at = pages.select("page_id", "fetched_at")
    rows = static.join(at, "page_id")
    e, selector = F.col("evidence"), F.col("evidence.selector_or_xpath")
    shot = F.concat_ws("_", F.lit("static"), F.substring(F.md5(e["source_url"]), 1, 8), F.substring(F.md5(selector), 1, 8), F.date_format("fetched_at", "yyyyMMdd_HHmmss"))
    evidence = F.struct(
        e["source_url"].alias("source_url"), selector.alias("selector_or_xpath"), e["verbatim_quote"].alias("verbatim_quote"), F.concat(shot, F.lit(".png")).alias("dom_node_screenshot"),
        F.col("fetched_at").alias("timestamp"), F.lit(PARSER_VERSION).alias("parser_version"), F.sha2(F.lower(T.strip(e["verbatim_quote"])), 256).alias("content_hash"),
    )
    # places in the input settle ties: pages by their ids, then candidates in the page's order
    seq = F.col("page_id") * 1_000_000 + F.col("place")
    made = rows.select(seq.alias("seq"), "company", "person_name", "role_title", "contact_type", "contact_value", e["source_url"].alias("page_url"), F.col("fetched_at").alias("captured_at"), evidence.alias("evidence"))
    return C.page_deduped(made)


def export_all(contacts: DataFrame, out: str, options: Options = Options()) -> dict:
    """Writes contacts, people and decision makers below out and returns the statistics. Raises if nothing is verified."""
    checked = C.validated(contacts).where(F.size("violations") == 0).drop("violations")
    kept = checked if options.include_all else checked.where("verification_status = 'VERIFIED'")
    kept = kept.persist()
    try:
        once = C.deduped(kept)
        writers.export(C.flat(once), f"{out}/contacts")
        writers.both(C.people(once.drop("verification_status")), f"{out}/contacts_people")
        if options.decision_only:
            makers = C.decision_people(once.drop("verification_status"), rules.level_of(options.min_level))
            writers.json_lines(makers, f"{out}/decision_people.json")
            writers.csv(C.decision_flat(makers), f"{out}/decision_people.csv")
        stats = C.export_stats(contacts).first().asDict()
        return stats | C.ecr(contacts, options.ecr_threshold).first().asDict()
    finally:
        kept.unpersist()


def filtered_people(people: DataFrame, min_level: str = "VP_PLUS") -> DataFrame:
    """People records of any columns with normalised values, level and reasons, those of the level and above."""
    email = V.filter_email(F.col("email")) if "email" in people.columns else F.lit("")
    ordinal, reasons = rules.filter_level(readers.first_title(people), email, readers.source_urls(people))
    made = people.withColumns({"_ordinal": ordinal, "decision_reasons": reasons})
    if "email" in people.columns:
        made = made.withColumn("email", email)
    if "phone" in people.columns:
        made = made.withColumn("phone", V.filter_phone(F.col("phone")))
    return made.withColumn("decision_level", rules.level_name(F.col("_ordinal"))).where(F.col("_ordinal") >= rules.level_of(min_level)).drop("_ordinal")


def run_filter(spark: SparkSession, people_path: str, out: str, min_level: str) -> int:
    kept = filtered_people(readers.people_json(spark, people_path), min_level).persist()
    try:
        writers.json_lines(kept, f"{out}/decision.json")
        writers.any_columns(kept, f"{out}/decision.csv")
        return kept.count()
    finally:
        kept.unpersist()
