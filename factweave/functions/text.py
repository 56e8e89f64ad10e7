"""Text columns that mean what Python's str methods mean: white space and digits are Unicode's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(F.length(strip(c)) == 0, F.lit(True))


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\D", "")


def person_key(name: Column) -> Column:
    """Lower case, commas and full stops as spaces, single spaces."""
    return squeeze(F.translate(F.lower(F.coalesce(name, F.lit(""))), ",.", "  "))


def title_case(c: Column) -> Column:
    """Every run of letters capitalised, whatever stands before it."""
    return F.array_join(F.transform(F.split(F.lower(c), r"(?<=\P{L})(?=\p{L})"), F.initcap), "")


def present(*items: Column) -> Column:
    """The items that aren't null, in order, as an array."""
    return F.array_compact(F.array(*items))


def flagged(rules: list[tuple[Column, str]]) -> Column:
    """The names of the rules that hold, in their order."""
    return present(*(F.when(test, F.lit(name)) for test, name in rules))
