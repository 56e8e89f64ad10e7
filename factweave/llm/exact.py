"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after deleting every character of `[\\x20\\x09-\\x0D]`. Of equal texts the row with
the most code points in the original text stays, then the one with the smallest doc_id.

1. Each row becomes (doc_id, SHA-256 of the normalised text, code points); the text goes no further.
2. Misra-Gries: every task keeps at most COUNTERS counters; their sums over tasks fall short of the true counts by at most
   rows / COUNTERS, and fewer than COUNTERS digests have a sum above that. Those are the frequent ones.
3. Their winners and sizes, counted exactly with partial aggregation, are fewer than COUNTERS rows: they are broadcast, and
   rows of frequent digests are settled where they lie.
4. All other digests, none of which has more than 2 * rows / COUNTERS rows, are shuffled and aggregated in the ordinary way.

Defined cases: null counts as the empty text; all texts of white space are equal; a null doc_id comes after all others; rows
with the same id, length and normalised text are one document, and stay or go together; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, only, parted

COUNTERS = 512
#: What the normalised text leaves out.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def _digests():
    def one(batch: pa.RecordBatch) -> dict:
        digest, points = [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            digest.append(hashlib.sha256(b"".join(text.encode().split())).digest())  # cuts at exactly that class
            points.append(len(text))
        return {"doc_id": batch.column("doc_id"), "digest": digest, "points": points}

    return one


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (binary), points."""
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return map_batches(slim, "doc_id long, digest binary, points long", lambda: _digests())


def shrink(counts: Counter, most: int) -> Counter:
    """Misra-Gries: at most `most` counters, each less by the largest count that goes."""
    if len(counts) <= most:
        return counts
    off = sorted(counts.values(), reverse=True)[most]
    return Counter({k: v - off for k, v in counts.items() if v > off})


def _summary(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts.update(batch.column(0).to_pylist())
            counts = shrink(counts, most)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["digest", "low"])

    return run


def frequent(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest) of every digest with more than 2 * n / counters rows, and perhaps some with fewer; under `counters` rows."""
    n = rows.count()
    sums = rows.select("digest").mapInArrow(_summary(counters), "digest binary, low long").groupBy("digest").agg(F.sum("low").alias("low"))
    return sums.where(F.col("low") > n // counters).select("digest")


def resolve(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """doc_id, digest, points, keep_id, group_size, kept for every row of `rows` (a written table of digests())."""
    heavy = materialise(frequent(rows, counters), "heavy")
    first = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"))
    group = [F.min(first).alias("best"), F.count("*").alias("group_size")]
    winners = rows.join(F.broadcast(heavy), "digest", "left_semi").groupBy("digest").agg(*group)
    split = rows.join(F.broadcast(materialise(winners, "winners")), "digest", "left")
    settled = split.where("group_size is not null")
    rest = rows.join(F.broadcast(heavy), "digest", "left_anti")
    ordinary = rest.join(materialise(rest.groupBy("digest").agg(*group), "ordinary"), "digest")
    both = settled.unionByName(ordinary)
    return both.select("doc_id", "digest", "points", F.col("best.id").alias("keep_id"), "group_size", (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("points") == -F.col("best.less"))).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay (see the module's text)."""
    found = resolve(materialise(digests(docs, id_col, text_col), "digests"))
    gone = materialise(found.where("not kept").select(F.col("doc_id").alias("gone"), "digest", "points").distinct(), "gone")
    few, rest = parted(docs, gone.select("gone"), id_col)
    text = F.coalesce(few[f"`{text_col}`"], F.lit(""))
    plain = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), SPACE, text)
    on = few[f"`{id_col}`"].eqNullSafe(gone["gone"]) & (F.char_length(text) == gone["points"]) & (F.unhex(F.sha2(plain, 256)) == gone["digest"])
    return rest.union(few.join(gone, on, "left_anti"))
