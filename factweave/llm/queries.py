"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import bpe, decontam, exact, hosts, langid, licenses, quality, records, simhash, substring
from .common import fresh_path, materialise, remainder, table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = langid.train(docs.where(~held_out).select("doc_id", "lang", "text"))
    return langid.identify(docs, model).withColumn("held_out", held_out)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "op3-records")
    records.write(table(spark, sf_dir, "documents"), f"{path}/records", public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    index = records.build_index(spark, f"{path}/records", f"{path}/index")
    return records.with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = materialise(simhash.fingerprints(table(spark, sf_dir, "documents"), shingle=4), "op4-prints")
    found = simhash.near_duplicates(prints, simhash.EXACT_4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated(table(spark, sf_dir, "documents"), window=35).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that leaked into it."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(exact.digests(table(spark, sf_dir, "documents")), "op8-digests")
    return exact.resolve(rows).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


#: Rules that come before the reputation. Fixed values.
URL_RULES = [hosts.Rule("com", "/", "allow"), hosts.Rule("example.com", "/en/", "block"), hosts.Rule("www.example.com", "/en/", "allow"), hosts.Rule("net", "/es/", "block"), hosts.Rule("net", "/fr/", "block")]


def op9_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: `labels.quality` of the document with the page's id, 0 is bad."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return hosts.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label) of the rows that may train."""
    return table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 4) != 2).select("doc_id", F.col("quality").alias("label"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), quality_labels(spark, sf_dir))
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= quality.GOOD).cast("int").alias("predicted"))


QUERIES = {"op1_langid": op1_langid, "op2_bpe": op2_bpe, "op3_token_records": op3_token_records, "op4_simhash": op4_simhash, "op5_substring": op5_substring, "op6_decontam": op6_decontam, "op7_licenses": op7_licenses, "op8_exact": op8_exact, "op9_hosts": op9_hosts, "op10_quality": op10_quality}

ORACLES: dict[str, str] = {}

ORACLES["op8_exact"] = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
    FROM documents
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (
    SELECT doc_id, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY h) AS group_size, h AS text_sha256
    FROM d
)
"""

ORACLES["op9_hosts"] = r"""
WITH u AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM u
), o AS (
    SELECT host, count(*) AS n, sum(1 - quality) AS bad
    FROM p JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL GROUP BY host
), parts AS (
    SELECT host, string_split(host, '.') AS s FROM (SELECT DISTINCT host FROM p)
), two AS (
    SELECT host, array_to_string(s[-2:], '.') AS last2, array_to_string(s[-3:], '.') AS last3, s[-1] AS last1,
           array_to_string(s[-2:], '.') IN ('ac.uk', 'co.jp', 'co.nz', 'co.uk', 'co.za', 'com.au', 'com.br', 'com.mx', 'gov.uk', 'org.uk') AS wide
    FROM parts
), h AS (
    SELECT two.host, CASE WHEN wide THEN last3 ELSE last2 END AS domain, CASE WHEN wide THEN last2 ELSE last1 END AS suffix,
           coalesce(n, 0)::DOUBLE AS n, coalesce(bad, 0)::DOUBLE AS bad
    FROM two LEFT JOIN o ON two.host = o.host
), d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
t AS (SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) ELSE 0 END AS overall FROM h),
sums AS (
    SELECT level, count(*) AS k, sum(n) AS n, sum(bad) AS x, sum(bad * bad / n) AS xx, sum(n * n) AS nn
    FROM (SELECT 'h' AS level, n, bad FROM h UNION ALL SELECT 'd', n, bad FROM d UNION ALL SELECT 's', n, bad FROM s)
    WHERE n > 0 GROUP BY level
), rho AS (
    SELECT level, CASE WHEN k > 1 AND x > 0 AND x < n AND n - nn / n - (k - 1) > 0
        THEN least(0.999, greatest(0.001, ((xx - x * x / n) / (x / n * (1 - x / n)) - (k - 1)) / (n - nn / n - (k - 1)))) ELSE 0.001 END AS r
    FROM sums
), w AS (
    SELECT coalesce((SELECT 1 / r - 1 FROM rho WHERE level = 'h'), 999.0) AS wh, coalesce((SELECT 1 / r - 1 FROM rho WHERE level = 'd'), 999.0) AS wd,
           coalesce((SELECT 1 / r - 1 FROM rho WHERE level = 's'), 999.0) AS ws
), sm AS (SELECT suffix, (bad + overall * ws) / (n + ws) AS prior FROM s, t, w),
dm AS (SELECT domain, (bad + sm.prior * wd) / (n + wd) AS prior FROM d JOIN sm ON d.suffix = sm.suffix, w),
hm AS (SELECT host, (bad + dm.prior * wh) / (n + wh) AS m, n + wh AS size FROM h JOIN dm ON h.domain = dm.domain, w),
low AS (SELECT host, m - 1.645 * sqrt(m * (1 - m) / (size + 1)) AS low FROM hm),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
    SELECT page_id, max_by(rh || rp, length(rh || rp)) AS rule, max_by(v, length(rh || rp)) AS v
    FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, best.rule, coalesce(best.v, CASE WHEN low.low > 0.2 THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best ON p.page_id = best.page_id LEFT JOIN low ON p.host = low.host
"""

ORACLES["op5_substring"] = r"""
WITH t AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), win AS (
    SELECT r, s, array_to_string(w[s:s + 34], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM t WHERE len(w) >= 35)
), rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
cov AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM win WHERE k IN (SELECT k FROM rep)),
gone AS (SELECT r, list(p) AS ps FROM cov GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(coalesce(ps, [])) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ps, []), i)), ' ')) AS kept_sha256
FROM t LEFT JOIN gone USING (r)
"""
