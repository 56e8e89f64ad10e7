"""Columns over e-mail addresses, telephone numbers and cards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import digits, strip

#: Patterns of values in running text. Fixed values.
EMAIL = r"(?i)\b[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}\b"
PHONE = r"(?:\+?1[-\s]?)?\(?\d{3}\)?[-\s]?\d{3}[-\s]?\d{4}|\+?\d{1,3}[-\s]?\(?\d{1,4}\)?[-\s]?\d{1,4}[-\s]?\d{1,9}"
GENERIC_INBOX = r"(?i)^(info|contact|office|support|help|hr|jobs|careers|sales|billing|hello|team)@"
#: Free mail domains, for extraction and for probing. Fixed values.
FREE_MAIL = ("gmail.com", "yahoo.com", "outlook.com", "hotmail.com", "aol.com", "icloud.com", "proton.me", "protonmail.com")
FREE_PROBE = ("gmail.com", "googlemail.com", "outlook.com", "hotmail.com", "live.com", "yahoo.com", "yandex.ru", "mail.ru")


def emails(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0))


def phones(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PHONE), F.lit(0))


def date_like(d: Column) -> Column:
    return d.rlike(r"^(19|20)\d{6,8}$")


def plausible_phone(d: Column) -> Column:
    """Digits that may be a number found in text."""
    return (F.length(d).between(10, 15)) & ~date_like(d)


def without_country(d: Column) -> Column:
    return F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)


def not_toll_free(value: Column) -> Column:
    return (~digits(value).rlike("^(800|888|877|866)")).cast("int")


def deobfuscated(text: Column) -> Column:
    """The first address in text after spelled-out signs are put back; null if there is none."""
    s = F.replace(text, F.lit("​"), F.lit(""))
    for word, sign in (("at", "@"), ("dot", ".")):
        s = F.regexp_replace(s, rf"(?i)\s*[(\[]?{word}[)\]]\s*", sign)
        s = F.replace(s, F.lit(f" {word} "), F.lit(sign))
    s = F.regexp_replace(s, r"\s*@\s*", "@")
    s = F.regexp_replace(s, r"\s*\.\s*", ".")
    s = F.regexp_replace(s, r"(?i)mailto:\s*", "")
    direct = F.regexp_extract(s, EMAIL, 0)
    quoted = F.array_join(F.regexp_extract_all(text, F.lit("[\"']([A-Za-z0-9._%+@-]+)[\"']"), F.lit(1)), "")
    joined = F.when(F.lower(text).contains("mailto"), F.regexp_extract(quoted, EMAIL, 0)).otherwise("")
    return F.nullif(F.when(direct != "", direct).otherwise(joined), F.lit(""))


def from_mailto(href: Column, shown: Column) -> Column:
    """The address of a mailto link, without parameters, lower-cased; else the first in its text."""
    raw = F.lower(strip(F.regexp_replace(F.regexp_replace(strip(href), "(?i)^mailto:", ""), r"(?s)[?#].*$", "")))
    starts = raw.rlike("^" + EMAIL.removeprefix("(?i)"))
    return F.when(starts, raw).otherwise(F.nullif(F.regexp_extract(F.lower(shown), EMAIL, 0), F.lit("")))


def filter_email(raw: Column) -> Column:
    """For the post-filter: bracketed signs put back, brackets and spaces gone, lower case."""
    s = F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?i)[(\[]\s*at\s*[)\]]", "@")
    s = F.regexp_replace(s, r"(?i)[(\[]\s*dot\s*[)\]]", ".")
    return F.lower(F.regexp_replace(s, r"[\[\](){}<>\s]", ""))


def filter_phone(raw: Column) -> Column:
    """No digits: empty; after a plus: plus and digits; else +1 and digits."""
    d = digits(raw)
    return F.when(d == "", "").when(strip(raw).startswith("+"), F.concat(F.lit("+"), d)).otherwise(F.concat(F.lit("+1"), d))


def vcard_title(body: Column) -> Column:
    """The first TITLE or ROLE line's value, else the first ORG line's; null if neither."""
    def line(names: str) -> Column:
        return F.nullif(strip(F.regexp_extract(body, rf"(?mi)^(?:{names}):(.*)$", 1)), F.lit(""))

    return F.coalesce(line("TITLE|ROLE"), line("ORG"))


def domain_of(email: Column) -> Column:
    """What follows the last @, lower-cased; null if either side is empty."""
    return F.nullif(F.lower(F.regexp_extract(strip(email), r"^.+@([^@]+)$", 1)), F.lit(""))
