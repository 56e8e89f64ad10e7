"""Sources: URL lists, people as JSON, e-mail lists, gold files, fetch results."""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import present, strip

USER_AGENT = "factweave"


def url_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, url) of a text file: blank lines and comments go; what has a full stop but no scheme gets https."""
    s = strip(F.col("value"))
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), s.alias("s")).where((F.col("s") != "") & ~F.col("s").startswith("#"))
    return rows.select("line", F.when(F.col("s").rlike("^https?://"), F.col("s")).when(F.col("s").contains("."), F.concat(F.lit("https://"), "s")).otherwise(F.col("s")).alias("url"))


def people_json(spark: SparkSession, path: str) -> DataFrame:
    """A list of objects; whatever columns they have."""
    return spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path)


def first_title(df: DataFrame) -> Column:
    """The first of the usual columns for a title that isn't blank; else empty."""
    have = [F.nullif(strip(F.col(c).cast("string")), F.lit("")) for c in ("role_title", "title", "position", "role") if c in df.columns]
    return F.coalesce(*have, F.lit(""))


def source_urls(df: DataFrame) -> Column:
    """All columns that hold a source URL, and that of an evidence struct."""
    flat = [F.col(c) for c in df.columns if c.startswith("source_url")]
    nested = [F.col("evidence.source_url")] if dict(df.dtypes).get("evidence", "").startswith("struct") else []
    return present(*flat, *nested) if flat or nested else F.expr("cast(array() as array<string>)")


def email_list(spark: SparkSession, path: str) -> DataFrame:
    """(seq, email) of the tokens with an @ in a text or CSV file, each at its first place."""
    tokens = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.posexplode(F.split("value", r"[,;\s\"]+")).alias("k", "email")).where(F.col("email").contains("@"))
    places = tokens.groupBy("email").agg(F.min(F.struct("line", "k")).alias("at")).withColumn("part", F.shiftright("at.line", 33))
    # lines are numbered by the part of the input they were read in, so each part is ordered apart
    parts = places.groupBy("part").agg(F.count("*").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("at"))
    return places.withColumn("nth", nth).join(before, "part").select((F.col("before") + F.col("nth")).alias("seq"), "email")


def gold(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(glob).withColumn("file", F.input_file_name())


def fetched(raw: DataFrame) -> DataFrame:
    """Derived columns of fetch results (url, status_code, content_type, body): mime without parameters, length in bytes, html
    only where it is HTML."""
    mime = F.lower(strip(F.substring_index("content_type", ";", 1)))
    return raw.select("url", "status_code", mime.alias("mime"), F.octet_length("body").cast("long").alias("content_length"), F.when(mime == "text/html", F.col("body")).alias("html"))


def _robots(status: pd.Series, body: pd.Series, url: pd.Series) -> pd.Series:
    def allowed(code: float, text: str | None, u: str) -> bool:
        if pd.isna(code) or code >= 400:
            return True
        rules = RobotFileParser()
        rules.parse((text or "").splitlines())
        return rules.can_fetch(USER_AGENT, u) and rules.can_fetch("*", u)

    return pd.Series([allowed(*row) for row in zip(status, body, url, strict=True)])


def robots_allowed(pages: DataFrame, robots: DataFrame) -> DataFrame:
    """pages (url, host) with `allowed`; robots: (host, status_code, body). No file, or none to be had: allowed."""
    both = pages.join(robots.select("host", F.col("status_code").alias("_s"), F.col("body").alias("_b")), "host", "left")
    return both.withColumn("allowed", F.pandas_udf(_robots, "boolean")(F.col("_s"), F.col("_b"), F.col("url"))).drop("_s", "_b")


def head_ok(pages: DataFrame, heads: DataFrame) -> DataFrame:
    """pages (url) with `ok`: the probe (url, status_code, content_type) found HTML, or there is none."""
    found = heads.select("url", ((F.col("status_code") < 400) & F.lower("content_type").startswith("text/html")).alias("ok"))
    return pages.join(found, "url", "left").withColumn("ok", F.coalesce("ok", F.lit(True)))
