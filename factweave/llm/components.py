"""Connected components of an edge table, distributed, with lineage cut in every round."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release

#: Edges that one union-find in a task holds before it hands on a spanning forest of them.
FOREST_EDGES = 200_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a spanning forest of each run of edges, as stars around the smallest node."""
    root: dict[int, int] = {}
    seen = 0

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    def stars() -> pa.RecordBatch:
        pairs = [(x, top) for x in root if (top := find(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        seen += batch.num_rows
        if seen >= FOREST_EDGES:
            yield stars()
            root, seen = {}, 0
    yield stars()


def connected_components(edges: DataFrame, max_rounds: int = 60, small: int = FOREST_EDGES) -> DataFrame:
    """(node, component) for every node that has an edge; the component is its smallest node.

    edges: two long columns u, v; directions, repeats and loops don't matter, rows with a null are no edges.
    Every task first contracts its own edges to a forest, which is contracted in one task if it has at most FOREST_EDGES; else large-star and small-star rounds run until the
    edges stay as they are, which takes a number of rounds that grows with the logarithm of the longest chain.
    """
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u is not null and v is not null and u <> v")
    now = materialise(pairs.mapInArrow(_forest, "u long, v long").distinct(), "edges")
    if now.count() <= small:  # then one task can hold them
        stars = materialise(now.coalesce(1).mapInArrow(_forest, "u long, v long"), "stars")
        return _rows(stars)
    mark = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        fewer = large.join(first, "u")
        fewer = fewer.select(F.col("v").alias("u"), F.col("m").alias("v")).union(first.select("u", F.col("m").alias("v")))
        fewer = fewer.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        before, now = now, materialise(fewer, "edges")
        here = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        release(before)
        if here == mark:
            break
        mark = here
    else:
        raise RuntimeError("components did not settle")
    return _rows(now)


def _rows(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
