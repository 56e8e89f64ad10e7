"""Mail-deliverability policy over tables: quotas, caches, hosts in order, outcomes of earlier dialogues.

attempts: (seq, email). Every decision is made in the fixed order of the policy; each is a window or a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import contact_values as V

PER_DOMAIN, TTL_DAYS = 5, 7


def category(code: Column, raised: Column) -> Column:
    """'ok', 'temp', 'perm', 'network' or 'unknown'."""
    return F.when(raised, "network").when(code.between(200, 299), "ok").when(code.between(400, 499), "temp").when(code.between(500, 599), "perm").otherwise("unknown")


def ranked_hosts(mx: DataFrame) -> DataFrame:
    """(domain, pref, host, seq) to (domain, host, host_rank), by preference, then by place."""
    return mx.select("domain", "host", F.row_number().over(Window.partitionBy("domain").orderBy("pref", "seq")).alias("host_rank"))


def fresh(cache: DataFrame, now: Column, ttl_days: int = TTL_DAYS) -> DataFrame:
    """Rows of a cache (checked_at: seconds) that still count at `now` (seconds)."""
    return cache.where(now - F.col("checked_at") < ttl_days * 86400)


def decisions(attempts: DataFrame, cached: DataFrame, per_domain: int = PER_DOMAIN, skip_free: bool = True) -> DataFrame:
    """(seq, email, domain, decision), the decision being the first that holds of 'input' (no address), 'policy' (free mail),
    'quota' (the domain's uncached attempts before reach the cap), 'cached', 'probe'. cached: (email), fresh rows."""
    rows = attempts.withColumn("domain", V.domain_of(F.col("email"))).join(cached.select("email", F.lit(True).alias("hit")).distinct(), "email", "left")
    free = F.lit(skip_free) & F.coalesce(F.col("domain").isin(*V.FREE_PROBE), F.lit(False))
    counts = (F.col("domain").isNotNull() & ~free & F.col("hit").isNull()).cast("int")
    before = Window.partitionBy("domain").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("tried", F.coalesce(F.sum(counts).over(before), F.lit(0)))
    decision = F.when(F.col("domain").isNull(), "input").when(free, "policy").when(F.col("tried") >= per_domain, "quota").when(F.col("hit"), "cached").otherwise("probe")
    return rows.select("seq", "email", "domain", decision.alias("decision"))


def outcomes(probes: DataFrame, hosts: DataFrame, rcpt: DataFrame) -> DataFrame:
    """(seq, email, domain) with hosts (domain, host, host_rank) and rcpt (seq, mx_host, smtp_code, raised), the answers of each
    attempt's own dialogues: the first host that accepts decides, else the last; without a host there is no network."""
    tried = probes.join(hosts, "domain", "left").join(rcpt.withColumnRenamed("mx_host", "host"), ["seq", "host"], "left")
    ok = F.col("smtp_code").between(200, 299) & ~F.coalesce("raised", F.lit(False))
    result = F.struct("host", "smtp_code", "raised")
    by = tried.groupBy("seq", "email", "domain").agg(F.min_by(result, F.when(ok, F.col("host_rank"))).alias("won"), F.max_by(result, "host_rank").alias("last"), (F.count("host_rank") > 0).alias("mx_found"))
    r = F.coalesce("won", "last")
    kind = F.when(~F.col("mx_found"), "network").otherwise(category(r["smtp_code"], F.coalesce(r["raised"], F.lit(False))))
    return by.select("seq", "email", "domain", r["host"].alias("mx_used"), F.col("won").isNotNull().alias("accepts_rcpt"), r["smtp_code"].alias("smtp_code"), kind.alias("error_category"), "mx_found")
