"""Rule engines as generated columns: seniority of roles, and reasons to render a page.

A rule set is data; the columns made of it are literals and pattern tests that the optimizer folds into one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.contact_values import GENERIC_INBOX
from ..functions.text import flagged, squeeze
from ..functions.urls import path

LEVELS = ("UNKNOWN", "NON_DM", "MGMT", "VP_PLUS", "C_SUITE")
ORDINAL = {name: k for k, name in enumerate(LEVELS)}
#: Other spellings of levels. Fixed values.
ALIASES = {"NONDM": "NON_DM", "VP": "VP_PLUS", "CSUITE": "C_SUITE"}

#: Words of titles that decide nothing, in their order. Fixed values.
NEGATIVE = ("of counsel", "counsel", "associate", "assistant", "junior", "coordinator", "specialist", "analyst", "intern", "trainee", "staff", "support", "paralegal")
#: Titles by level, as (pattern, label) or a word that is both. Fixed values, in their order.
C_SUITE = ("general counsel", ("(?<!vice )president", "president"), "managing director", "managing partner", "executive director", ("chief [a-z]+ officer", "chief officer"), "ceo", "cfo", "coo", "cto", "cmo", "cio", ("co-?chair", "co-chair"), "group chair", "chair")
VP_PLUS = ("senior director", "director", "head of", "vice president", "svp", "evp", "vp", "shareholder", "principal", "partner")
MGMT = ("lead", "manager")
#: Sections of sites where decision makers are listed. Fixed values, in their order.
HINTS = ("leadership", "executive", "management", "board", "partners", "shareholders", "principals")
#: The post-filter's own order of titles. Fixed values.
FILTER_C_SUITE = (r"general\s+counsel", r"chief\s+[a-z]+\s+officer", "ceo", "cfo", "coo", "cto", "cmo", "cio", "president", r"managing\s+director", r"managing\s+partner", r"executive\s+director", "co-?chair", r"group\s+chair", "chair")
FILTER_VP_PLUS = ("shareholder", "principal", "partner", r"senior\s+director", "director", r"head\s+of", r"vice\s+president", "svp", "evp", "vp")


def level_of(name: str) -> int:
    """The ordinal of a level's name in any spelling; unknown names are UNKNOWN."""
    key = name.strip().upper().replace("-", "_").replace(" ", "_")
    return ORDINAL.get(ALIASES.get(key, key), 0)


def level_name(ordinal: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, LEVELS)), ordinal + 1)


def _word(pattern: str) -> str:
    return rf"(?i)\b{pattern}\b"


def _lift(base: Column, hinted: Column) -> Column:
    """One level up where a hint meets a level that the title doesn't settle."""
    return F.when(hinted & base.isin(ORDINAL["UNKNOWN"], ORDINAL["MGMT"]), base + 1).otherwise(base)


def role_level(title: Column, url: Column) -> tuple[Column, Column]:
    """(ordinal, reasons) for consolidated people: an exclusion ends it, else the highest title counts; the first hint found
    anywhere in the URL is named, and lifts what is unknown or management by one."""
    t = F.coalesce(squeeze(title), F.lit(""))
    positive = [(p, p, lv) if isinstance(p, str) else (*p, lv) for lv, of in (("C_SUITE", C_SUITE), ("VP_PLUS", VP_PLUS), ("MGMT", MGMT)) for p in of]
    tests = [(t.rlike(_word(p)), label, ORDINAL[lv]) for p, label, lv in positive]
    best = F.greatest(F.lit(0), *(F.when(test, lv).otherwise(0) for test, _, lv in tests))
    excluded = F.coalesce(*(F.when(t.rlike(_word(p)), F.lit(f"exclude:{p}")) for p in NEGATIVE))
    hint = F.coalesce(*(F.when(F.lower(url).contains(h), F.lit(f"struct:{h}")) for h in HINTS))
    counsel = t.rlike(_word("general counsel"))
    base = F.when(counsel, 4).when(excluded.isNotNull(), 1).otherwise(best)
    named = F.when(counsel, F.array(F.lit("title:general counsel"))).when(excluded.isNotNull(), F.array(excluded)).otherwise(flagged([(test, f"title:{label}") for test, label, _ in tests]))
    return _lift(base, hint.isNotNull()), F.array_compact(F.concat(named, F.array(hint)))


def filter_level(title: Column, email: Column, urls: Column) -> tuple[Column, Column]:
    """(ordinal, reasons) for the post-filter: titles of the highest level come before exclusions, the first match of each
    level alone is named, and a hint must be a section of a source URL's path."""
    t = F.coalesce(title, F.lit(""))

    def first(patterns: tuple[str, ...]) -> Column:
        return F.coalesce(*(F.when(t.rlike(_word(p)), F.lit(rf"title:\b{p}\b")) for p in patterns))

    top, upper, middle = first(FILTER_C_SUITE), first(FILTER_VP_PLUS), first(MGMT)
    word = F.lower(F.regexp_extract(t, _word("(" + "|".join(n.replace(" ", r"\s+") for n in NEGATIVE) + ")"), 1))
    negative = F.when(top.isNull() & (word != ""), F.concat(F.lit("neg:"), word))
    base = F.when(top.isNotNull(), 4).when(negative.isNotNull(), 1).when(upper.isNotNull(), 3).when(middle.isNotNull(), 2).otherwise(0)
    hinted = F.exists(urls, lambda u: path(u).rlike("(?i)/(" + "|".join(HINTS) + ")(/|$)"))
    hinted = F.coalesce(hinted, F.lit(False))
    named = (F.when(email.rlike(GENERIC_INBOX), F.lit("email:generic")), F.coalesce(top, negative, upper, middle), F.when(hinted, F.lit("struct:leadership")))
    return _lift(base, hinted), F.array_compact(F.array(*named))


#: Marks of pages that only a browser shows whole. Fixed values, in their order.
ANTI_BOT = (r"Just a moment\s*\.\.\.", "Enable JavaScript and cookies to continue", "__cf_chl_")
SCRIPTED = (
    "data-cfemail", "cf_email", r"javascript:.*mailto", r"data-email\s*=", r"data-phone\s*=", "data-reactroot", "ng-app", r"show\s*(e-?mail|email)", r"reveal\s*(e-?mail|email)",
    r"display\s*(e-?mail|email)", r"показать\s*(e-?mail|email|почт\w+)", r"открыть\s*(e-?mail|email|почт\w+)",
)
CARD_CLASS, HEADING = r'(?i)class\s*=\s*"[^"]*(team|member|profile|person)[^"]*"', "(?i)<h[34][^>]*>"
#: Terms whose presence says that a page is about people. Fixed values.
TARGET_TERMS = ("team", "leadership", "management", "people", "staff", "executives")
TINY = 5 * 1024


def anti_bot(html: Column) -> Column:
    test = F.lit(False)
    for p in ANTI_BOT:
        test = test | html.rlike(f"(?i){p}")
    return F.coalesce(test, F.lit(False))


def cards_without_contacts(html: Column) -> Column:
    low = F.lower(html)
    anchors = low.contains('href="mailto:') | low.contains('href="tel:')
    return F.coalesce(~anchors & ((F.regexp_count(html, F.lit(CARD_CLASS)) >= 3) | (F.regexp_count(html, F.lit(HEADING)) >= 8)), F.lit(False))


def term_hits(html: Column) -> Column:
    low = F.lower(F.coalesce(html, F.lit("")))
    return sum((low.contains(t).cast("int") for t in TARGET_TERMS[1:]), low.contains(TARGET_TERMS[0]).cast("int"))


def escalation_reasons(mime: Column, content_length: Column, html: Column, hits: Column) -> Column:
    """Why a fetched page should be rendered, in a fixed order; empty: no reason."""
    other = F.when(mime.isNotNull() & (mime != "text/html"), F.concat(F.lit("mime!=text/html ("), mime, F.lit(")")))
    rules = [((hits == 0) & (content_length < TINY), "selector_hits==0 && content_length<5KiB"), (anti_bot(html), "anti-bot markers detected")]
    rules += [(html.rlike(f"(?iu){p}"), f"js:{p}") for p in SCRIPTED]
    rules.append((cards_without_contacts(html), "cards_present_but_no_mailto_tel"))
    return F.array_compact(F.array(other, *(F.when(test, F.lit(name)) for test, name in rules)))
