"""Fetch routing: target pages, caps, headless budgets, site counters and the acceptance of addresses of other domains.

What a sequential run would keep in counters is a window here: one shuffle by domain, host or input line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import contact_values as V
from ..functions import urls as U
from ..functions.text import flagged, present

SHARE, PER_DOMAIN, PER_RUN = 0.2, 2, 10
PAGES_PER_LINE, FOLLOW_UPS = 10, 5
#: Points for the signs that an address of another domain belongs to the person. Fixed values.
POINTS = {"title": 1, "mailto": 2, "phone": 2, "vcard": 2, "show-email": 1, "repeat>=3": 2, "repeat>=2": 1, "site>=5": 2, "site>=3": 1, "footer": 2, "neg-zone": -2}
ACCEPT_FROM = 5
#: Numbers (of which each has one page at most) that are looked at in order by one task.
CHUNK_BITS = 16


def candidates(lines: DataFrame, paths: tuple[str, ...] = U.INCLUDED, most: int = PAGES_PER_LINE) -> DataFrame:
    """(line, url) to (line, place, page): each line's own page and the usual ones, normalised, once each, `most` at most."""
    pages = lines.select("line", F.posexplode(U.expand(F.col("url"), list(paths))).alias("place", "page"))
    once = pages.groupBy("line", U.normalize(F.col("page")).alias("page")).agg(F.min("place").alias("place"))
    return once.withColumn("place", F.row_number().over(Window.partitionBy("line").orderBy("place"))).where(F.col("place") <= most)


def headless_grants(pages: DataFrame, share: float = SHARE, per_domain: int = PER_DOMAIN, per_run: int = PER_RUN) -> DataFrame:
    """(seq, domain, wants) with `granted` and `denial` ('' | 'quota' | 'domain cap' | 'run cap').

    A page may be rendered if the domain's share of rendered among all fetches, itself counted as fetched, is below `share`
    and neither cap is reached. A domain's grants are found by folding over its wanting pages in order: only those are
    gathered, and only until its cap is reached can a grant happen. The cap of the run is monotone, so it takes the first
    `per_run` of all grants by seq; a top-k finds where it falls.
    """
    n = F.row_number().over(Window.partitionBy("domain").orderBy("seq"))
    counted = pages.withColumn("n", n)
    # grant g (from 0) needs the first wanting page whose n makes g / (n + g) < share
    granted = counted.where("wants").select("domain", "seq", "n", F.lit(0).alias("k"))
    found = None
    previous = None
    for k in range(per_domain):
        fits = (F.lit(float(k)) / (F.col("n") + k)) < share
        later = granted if previous is None else granted.join(previous, "domain").where(F.col("seq") > F.col("last"))
        step = later.where(fits).groupBy("domain").agg(F.min("seq").alias("last"))
        found = step if found is None else found.unionByName(step)
        previous = step
    grants = found.select("domain", F.col("last").alias("granted_seq"))
    kept = grants.orderBy("granted_seq").limit(per_run)
    rows = counted.join(kept, (counted["domain"] == kept["domain"]) & (counted["seq"] == kept["granted_seq"]), "left").select(counted["*"], F.col("granted_seq").isNotNull().alias("granted"))
    before = F.coalesce(F.sum(F.col("granted").cast("int")).over(Window.partitionBy("domain").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("before", before)
    quota = F.col("before") / (F.col("n") + F.col("before")) >= share
    denial = F.when(~F.col("wants") | F.col("granted"), "").when(quota, "quota").when(F.col("before") >= per_domain, "domain cap").otherwise("run cap")
    return rows.select("seq", "domain", "wants", "granted", denial.alias("denial"))


def site_counts(pages: DataFrame, mails: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Running counts of mail domains over consecutive pages of one host: (seq, domain, page_count, site_count).

    pages: (seq, host); mails: (seq, domain, n). A host met again after another starts anew. The running order is global by
    definition: chunks of 2 ** chunk_bits numbers are ordered apart, then one row for each chunk tells whether its first
    island goes on from the chunk before; all else is by island and domain.
    """
    within, chunks = Window.partitionBy("chunk").orderBy("seq"), Window.orderBy("chunk")
    upto = (Window.unboundedPreceding, Window.currentRow)
    rows = pages.select("seq", "host", F.shiftright("seq", chunk_bits).alias("chunk"))
    rows = rows.withColumn("start", F.coalesce(F.col("host") != F.lag("host").over(within), F.lit(True)).cast("int"))
    ends = rows.groupBy("chunk").agg(F.min_by("host", "seq").alias("head"), F.max_by("host", "seq").alias("tail"), F.sum("start").alias("starts"))
    goes_on = F.coalesce(F.col("head") == F.lag("tail").over(chunks), F.lit(False)).cast("int")
    ends = ends.withColumn("added", F.col("starts") - goes_on)
    before = ends.select("chunk", (F.sum("added").over(chunks.rowsBetween(*upto)) - F.col("starts")).alias("before"))
    islands = rows.withColumn("nth", F.sum("start").over(within.rowsBetween(*upto))).join(before, "chunk")
    islands = islands.select("seq", (F.col("before") + F.col("nth")).alias("island"))
    rows = mails.join(islands, "seq").groupBy("island", "seq", "domain").agg(F.sum("n").alias("page_count"))
    running = Window.partitionBy("island", "domain").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select("seq", "domain", "page_count", F.sum("page_count").over(running).alias("site_count"))


def acceptance(prefix: str = "") -> tuple[Column, Column]:
    """(score, signals) over the columns has_title, from_mailto, has_phone, has_vcard, show_trigger, page_count, site_count,
    in_footer, negative_zone."""
    c = lambda name: F.col(prefix + name)
    tests = [
        (c("has_title"), "title"), (c("from_mailto"), "mailto"), (c("has_phone"), "phone"), (c("has_vcard"), "vcard"), (c("show_trigger"), "show-email"),
        (c("page_count") >= 3, "repeat>=3"), (c("page_count") == 2, "repeat>=2"), (c("site_count") >= 5, "site>=5"), (c("site_count").between(3, 4), "site>=3"),
        (c("in_footer"), "footer"), (c("negative_zone"), "neg-zone"),
    ]
    score = F.lit(0)
    for test, name in tests:
        score = score + F.when(test, POINTS[name]).otherwise(0)
    return score, flagged(tests)


def confirmed() -> tuple[Column, Column]:
    """(whether one strong sign is there, the signs that are missing)."""
    strong = [(F.col("has_phone"), "phone"), (F.col("has_vcard"), "vcard"), (F.col("page_count") >= 2, "page_repeat>=2"), (F.col("in_footer"), "footer_mention"), (F.col("site_count") >= 3, "site_repeat>=3")]
    any_ = F.lit(False)
    for test, _ in strong:
        any_ = any_ | test
    return any_, present(*(F.when(~test, F.lit(name)) for test, name in strong))


def accepted_email(allow_free: bool = False) -> Column:
    """Why an address (columns email_domain, site_host and those of acceptance()) is taken: 'suffix', 'brand', 'free',
    'cross-domain'; else 'rejected'. The suffix needs no full stop before it."""
    site = F.replace(F.lower("site_host"), F.lit("www."), F.lit(""))
    brand = U.registrable(F.col("email_domain")) == U.registrable(F.col("site_host"))
    free = F.lit(allow_free) & F.col("email_domain").isin(*V.FREE_MAIL)
    score, _ = acceptance()
    strong, _ = confirmed()
    return F.when(F.col("email_domain").endswith(site), "suffix").when(brand, "brand").when(free, "free").when((score >= ACCEPT_FROM) & strong, "cross-domain").otherwise("rejected")
