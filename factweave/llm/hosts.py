"""URL filters: allow and block rules by host and path, and empirical-Bayes host reputation where no rule fits.

Only DataFrame and SQL functions run. Host: what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased;
path: from there up to `?`, `#` or the end. A url that is null or has no `://` has both empty. A rule fits its host and all
subdomains of it if the path starts with the rule's path; the longest rule (host and path) wins.

Reputation: labelled outcomes of pages (bad: 1, good: 0) are counted by host. A host's prior is the posterior mean of its
registered domain, whose prior is that of its suffix, whose prior is the overall rate; each level's prior counts for as many
outcomes as the beta-binomial moment estimate of the spread between that level's members says. A host is blocked if the
lower bound of its posterior bad rate (mean less Z standard deviations of the beta posterior) is over WORST.

Defined cases: null and malformed urls share the empty host, which is judged like any other; hosts without outcomes have the
posterior of their domain, suffix or all; no outcomes at all: nothing is blocked but by rule; pages with several outcomes
count each; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, only

#: Standard deviations below the posterior mean, and the bad rate at which that bound blocks.
Z, WORST = 1.645, 0.2
#: Registered domains have one label more than their suffix; suffixes of two labels. Fixed values.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.mx", "gov.uk", "org.uk")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def by_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix); both the host itself if it has too few labels."""
    two = F.substring_index(host, ".", -2)
    wide = two.isin(*TWO_LABEL_SUFFIXES)
    return F.when(wide, F.substring_index(host, ".", -3)).otherwise(two), F.when(wide, two).otherwise(F.substring_index(host, ".", -1))


def prior_strength(counts: DataFrame) -> float:
    """How many outcomes a prior counts for, from the spread of bad rates between rows (n, bad): the moment estimate of a
    beta-binomial's intra-class correlation, held between 0.001 and 0.999, as outcomes."""
    s = counts.where("n > 0").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("x"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("xx"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    rho = 0.001
    if s.k and s.k > 1 and 0 < s.x < s.n:
        p = s.x / s.n
        spread, room = (s.xx - s.x * p) / (p * (1 - p)) - (s.k - 1), s.n - s.nn / s.n - (s.k - 1)
        rho = min(0.999, max(0.001, spread / room)) if room > 0 else 0.001
    return 1 / rho - 1


def reputation(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, mean, low (bound) for each row of hosts (host); outcomes: (host, bad), one row for each labelled page."""
    counted = materialise(outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad")), "host-outcomes")
    total = counted.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = total.bad / total.n if total.n else 0.0
    every = hosts.select("host").distinct().join(counted, "host", "left").fillna(0, ["n", "bad"])
    domain, suffix = levels(F.col("host"))
    every = materialise(every.withColumn("domain", domain).withColumn("suffix", suffix), "host-levels")
    counts = {"host": every, "domain": every.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "suffix": every.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))}
    weight = {k: prior_strength(v) for k, v in counts.items()}

    def mean(prior: Column, level: str) -> Column:
        return (F.col("bad") + prior * weight[level]) / (F.col("n") + weight[level])

    suffixes = counts["suffix"].select("suffix", mean(F.lit(overall), "suffix").alias("prior"))
    domains = materialise(counts["domain"].join(suffixes, "suffix").select("domain", mean(F.col("prior"), "domain").alias("prior")), "domain-means")
    of_host = every.join(domains, "domain").select("host", mean(F.col("prior"), "host").alias("mean"), (F.col("n") + weight["host"]).alias("size"))
    return of_host.select("host", "mean", (F.col("mean") - Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("size") + 1))).alias("low"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, low for every row of pages. outcomes: (page_id, bad)."""
    slim = only(pages, page_id=id_col, url=url_col)
    host, path = host_and_path(F.col("url"))
    split = materialise(slim.select("page_id", host.alias("host"), path.alias("path")), "pages-split")
    known = split.join(outcomes.where("bad is not null").select(F.col("page_id").alias("labelled"), "bad"), F.col("page_id") == F.col("labelled")).select("host", "bad")
    scores = materialise(reputation(split, known).select(F.col("host").alias("of_host"), "low"), "reputation")
    name, verdict = by_rule(F.col("host"), F.col("path"), rules)
    judged = split.join(scores, F.col("host") == F.col("of_host"), "left")
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("low") > WORST, "block").otherwise("allow")).alias("verdict"), "low")
