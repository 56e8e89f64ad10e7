"""Relations that the registered queries read: a synthetic contact relation, made by SQL text that both engines run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations")

#: Rows of contacts without their constant evidence columns.
CONTACTS_SQL = """
WITH k AS (
  SELECT c.c_custkey AS seq, n.n_name, c.c_name, p.url AS page_url,
    replace(lower(n.n_name), '_', '') AS dom,
    split_part('Ada,Ben,Cleo,Dov', ',', CAST(c.c_custkey % 4 + 1 AS INT)) AS fn,
    split_part('Arden,Birch,Cole,Dune,Elm', ',', CAST(c.c_custkey % 5 + 1 AS INT)) AS ln,
    coalesce(o.last_ts, TIMESTAMP '2024-01-01 00:00:00') AS captured_at
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN pages p ON p.page_id = c.c_custkey % 50
  LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_ts FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey)
SELECT seq,
  CASE WHEN seq % 19 = 0 THEN concat(' ', lower(n_name), ' ') ELSE n_name END AS company,
  concat(fn, CASE WHEN seq % 23 = 0 THEN '  ' ELSE ' ' END, ln, CASE WHEN seq % 29 = 0 THEN ', Jr.' ELSE '' END) AS person_name,
  split_part('President|Vice President|Managing Director|Director of Sales|Associate|General Counsel|Of Counsel|Head of Data|Team Lead|Account Manager|Unknown|Partner|Co-Chair|Analyst|Chief Data Officer|Gardener|Assistant to the CEO', '|', CAST(seq % 17 + 1 AS INT)) AS role_title,
  CASE seq % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'phone' ELSE 'link' END AS contact_type,
  CASE seq % 3
    WHEN 0 THEN concat(CASE WHEN seq % 13 < 4 THEN 'INFO' ELSE lower(concat(fn, '.', ln)) END, '@', dom, '.example')
    WHEN 1 THEN concat(CASE WHEN seq % 37 < 10 THEN '+1 (800) 555-01' ELSE '(555) 555-01' END, lpad(CAST(seq % 9 AS STRING), 2, '0'))
    ELSE concat('https://', dom, '.example/v/', lower(fn), CASE WHEN seq % 11 = 0 THEN '.html' ELSE '.vcf' END) END AS contact_value,
  split_part('div.card a[href*=''mailto:'']|div.card a[href*=''tel:'']|div.card :text-email|div.card :text-phone|tr a[href$=''.vcf'']|div.card a[href*=''tel:'']|div.card a[href*=''mailto:'']', '|', CAST(seq % 7 + 1 AS INT)) AS selector_or_xpath,
  concat('https://www.', dom, '.example/', split_part('team/,about,leadership?x=1,our-team#a,contact,board,about/us/,news,people,team,about', ',', CAST(seq % 11 + 1 AS INT))) AS source_url,
  CASE WHEN seq % 31 = 0 THEN '  ' ELSE concat('quote ', c_name) END AS verbatim_quote,
  page_url, captured_at
FROM k
"""
PARSER_VERSION, SCREENSHOT = "0.1.0", "shots/none.png"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, company, person_name, role_title, contact_type, contact_value, page_url, captured_at, evidence."""
    for name in ("customer", "nation", "pages", "orders"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    rows = spark.sql(CONTACTS_SQL)
    evidence = F.struct(
        "source_url", "selector_or_xpath", "verbatim_quote", F.lit(SCREENSHOT).alias("dom_node_screenshot"), F.col("captured_at").alias("timestamp"),
        F.lit(PARSER_VERSION).alias("parser_version"), F.sha2(F.lower(F.trim("verbatim_quote")), 256).alias("content_hash"),
    )
    return rows.select("seq", "company", "person_name", "role_title", "contact_type", "contact_value", "page_url", "captured_at", evidence.alias("evidence"))
