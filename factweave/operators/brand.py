"""Whether a mail domain is the site's brand: the same registrable domain, or names that differ little."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import registrable

LEAST = 0.9


def brand_matches(pairs: DataFrame, least: float = LEAST) -> DataFrame:
    """pairs (email_domain, site_host) with `same_brand`. The ratio, which needs Python, is taken of distinct residual pairs."""
    keyed = pairs.withColumns({"_a": registrable(F.col("email_domain")), "_b": registrable(F.col("site_host"))})

    def close(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(close=[SequenceMatcher(None, a, b).ratio() >= least for a, b in zip(frame["_a"], frame["_b"], strict=True)])

    rest = keyed.where("_a <> _b").select("_a", "_b").distinct().mapInPandas(close, "_a string, _b string, close boolean")
    return keyed.join(rest, ["_a", "_b"], "left").withColumn("same_brand", F.coalesce(F.col("close"), F.col("_a") == F.col("_b"))).drop("_a", "_b", "close")
