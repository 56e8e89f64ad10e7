"""URL columns. A URL is `scheme:`, `//authority`, path, `?query`, `#fragment`; every part may be missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
#: Second-level labels that make a registrable domain three labels long. Fixed values.
SECOND_LEVEL = ("co", "com", "org", "net", "gov", "ac", "edu")
#: Words in a path that mark a page worth a visit, by use. Fixed values.
RUN_TARGETS = ("team", "our-team", "people", "leadership", "management", "contacts", "imprint", "impressum")
INCLUDED = ("/about", "/team", "/leadership", "/management", "/contacts", "/contact", "/imprint", "/impressum")
LISTINGS = ("/team", "/our-team", "/people", "/leadership", "/management")
SEMANTIC = ("/leadership", "/our-team", "/team")
NEGATIVE_ZONES = ("/press", "/news", "/media", "/newsroom", "/careers", "/jobs", "/vacancies", "/employment", "/agency")


def scheme(u: Column) -> Column:
    return F.regexp_extract(u, _PARTS, 1)


def authority(u: Column) -> Column:
    """With port and user information, lower-cased."""
    return F.lower(F.regexp_extract(u, _PARTS, 2))


def path(u: Column) -> Column:
    return F.regexp_extract(u, _PARTS, 3)


def normalize(u: Column, keep_trailing_slash: bool = False, any_scheme: bool = False) -> Column:
    """Lower-case authority, no query, no fragment, no slashes at the end but the root's. Without a scheme, unchanged."""
    p = path(u)
    cut = p if keep_trailing_slash else F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))
    made = F.concat(F.when(scheme(u) != "", F.concat(F.lower(scheme(u)), F.lit(":"))).otherwise(""), F.when(u.contains("//"), F.concat(F.lit("//"), authority(u))).otherwise(""), cut)
    return made if any_scheme else F.when(scheme(u) == "", u).otherwise(made)


def for_report(u: Column) -> Column:
    """Normalised, and without one leading www."""
    return F.regexp_replace(normalize(u, any_scheme=True), r"^([a-z][a-z0-9+.\-]*:)?//www\.", "$1//")


def registrable(host: Column) -> Column:
    """The last two labels, or three after a short top level with a second level like co."""
    h = F.lower(F.coalesce(host, F.lit("")))
    labels = F.split(h, r"\.")
    n = F.size(labels)
    three = (n >= 3) & F.element_at(labels, -2).isin(*SECOND_LEVEL) & (F.length(F.element_at(labels, -1)) <= 3)
    return F.when(n < 2, h).when(three, F.substring_index(h, ".", -3)).otherwise(F.substring_index(h, ".", -2))


def any_in(c: Column, words: tuple[str, ...]) -> Column:
    test = F.lit(False)
    for w in words:
        test = test | c.contains(w)
    return F.coalesce(test, F.lit(False))


def run_target(u: Column) -> Column:
    return any_in(F.lower(path(u)), RUN_TARGETS)


def ingest_target(u: Column) -> Column:
    """Only the first alternative needs its slash."""
    return F.lower(path(u)).rlike("/(our-)?team|people|leadership|management")


def listing(u: Column) -> Column:
    return any_in(F.lower(path(u)), LISTINGS)


def semantic(u: Column) -> Column:
    return any_in(F.lower(u), SEMANTIC)


def negative_zone(u: Column) -> Column:
    return any_in(F.lower(path(u)), NEGATIVE_ZONES)


def same_site(a: Column, b: Column) -> Column:
    """Hosts equal after stripping the characters w and full stop from the left; no host is the same site."""
    return (authority(b) == "") | (F.ltrim(authority(a), F.lit("w.")) == F.ltrim(authority(b), F.lit("w.")))


def expand(u: Column, paths: list[str]) -> Column:
    """The page itself and the given paths of its origin, once each, in order; what is no http(s) URL stays alone."""
    origin = F.concat(scheme(u), F.lit("://"), F.regexp_extract(u, _PARTS, 2))
    more = [F.concat(origin, F.lit("/" + p.lstrip("/"))) for p in paths]
    return F.when(u.rlike("^https?://"), F.array_distinct(F.array(F.regexp_replace(u, "/+$", ""), *more))).otherwise(F.array(u))
