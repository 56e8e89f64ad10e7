"""SimHash near-duplicates by multi-index hashing.

Texts: A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`, shingles of some words joined by one space (fewer words: the whole
sequence; none, or null: no shingle). A fingerprint is one or more 64-bit lanes; bit by bit it holds what more than half of
the shingle hashes have. Lane 0 uses XXH64 with seed 42, further lanes a bijective mix of it.

Index: each fingerprint is filed under the values of a small Hamming ball around each of its segments; only clear bits are
set, so two values meet if each has at most `radius` set bits that the other lacks, which covers all that differ in `radius`
bits. Fingerprints that meet are compared over their complete distance. Segments are as wide as the logarithm of the number
of fingerprints, so that the unlike ones that meet stay as few at any size.

1. What is filed carries a sketch: lanes that no segment is taken from, for segments that met agree in their own bits, like
   or not. A left-semi join keeps the fingerprints that have a neighbour at all, or another set with the same sketch; where
   there are further lanes to compare, a second one with all of them keeps fewer.
2. Dense groups would give all their pairs. So in ROUNDS rounds each fingerprint is compared with one of each of its buckets
   (of those that a pair shares by one segment, under one), the nearest is confirmed, and the components of the confirmed
   links are found: no more rows than are filed.
3. Only pairs of different components are then looked for, and in a bucket only by those outside the component of most there.

Two uses. `near_duplicates`: fingerprints of all shingles, repeats included, link at 4 or fewer differing bits; no pair can be
missed. `keep_one` (the pipeline's stage): fingerprints of the distinct shingles in many lanes propose pairs, and the exact
Jaccard similarity of the shingle sets decides, SIMILAR or more. The index meets a pair at 0.8 with probability 0.998
(MET at an angle a little wider). Sets of at most SHORT shingles, whose fingerprints are coarse, are filed under the first of
their shingles in one order instead, and so are those of up to LONG, which a short set can be similar to: no such pair is lost,
and every pair is in one of the two indexes whole. A parity bitmap (sets differ in at least the shingles
that their bitmaps differ in) refuses most loose pairs beforehand, without loss.

Defined cases: null and blank texts are equal, have fingerprint zero and are linked like any other; texts of any length are
hashed whole; rows with a null id have a null component_id, link nothing and stay; repeated ids share their component in
`near_duplicates`, while in `keep_one` rows of one id and different texts are judged apart; of a group the smallest id stays,
of several texts with that id the one of least SHA-256, and its repeated rows stay together; columns of any name are carried
on; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import ceil, comb, log, log2, sqrt
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, only, parted, pieces, release
from .components import connected_components
from .kernels import U, Words, majority_bits, mix, xxh64_spans

#: Rounds of comparisons with one of each bucket, before pairs of different components are looked for.
ROUNDS = 3
#: Least Jaccard similarity, as a fraction.
SIMILAR = (4, 5)
#: Part of the bits that differ, up to which the index meets pairs with probability MET. At a similarity of 0.8 it is 0.15.
ANGLE, MET = 0.17, 0.99
#: Shingles of a set that is filed by its shingles alone, and of the largest that can be similar to it.
SHORT = 40
LONG = SHORT * SIMILAR[1] // SIMILAR[0]
#: 64-bit words of a set's parity bitmap.
PARITY = 8


@dataclass(frozen=True)
class Segment:
    """Bits of one lane that one table of the index is filed by; radius is the size of the ball."""

    lane: int
    shift: int
    width: int
    radius: int


@dataclass(frozen=True)
class Index:
    """lanes: of a fingerprint; most: bits of all lanes that may differ; what is filed carries the last `sketch` lanes, which
    may differ in `most_sketch` bits."""

    lanes: int
    segments: tuple[Segment, ...]
    most: int
    sketch: int
    most_sketch: int

    @property
    def exact(self) -> bool:
        """Whether no pair within `most` can be missed: the differing bits can't exceed every segment's radius at once."""
        bits = {(s.lane, b) for s in self.segments for b in range(s.shift, s.shift + s.width)}
        return len(bits) == sum(s.width for s in self.segments) and sum(s.radius + 1 for s in self.segments) > self.most and (self.lanes == 1 and self.most_sketch >= self.most)


#: Every pair that differs in at most 4 of 64 bits: radii 1, 1 and 0, or 2 and 1, leave no way to spread 4 differences.
EXACT_4 = Index(1, (Segment(0, 0, 22, 1), Segment(0, 22, 22, 1), Segment(0, 44, 20, 0)), 4, 1, 4)
EXACT_4_WIDE = Index(1, (Segment(0, 0, 32, 2), Segment(0, 32, 32, 1)), 4, 1, 4)


def exact_index(n: int) -> Index:
    """For n fingerprints: the wide segments have more values to file and fewer unlike fingerprints under each."""
    return EXACT_4 if n <= 1 << 25 else EXACT_4_WIDE


def similar_index(n: int) -> Index:
    """For n fingerprints: segments of log2(n) - 2 bits, 16 at least, as many as MET asks for."""
    width = min(32, max(16, ceil(log2(max(n, 2))) - 2))
    clear = (1 - ANGLE) ** width
    odds = ANGLE / (1 - ANGLE)
    met = clear * (1 + width * odds + comb(width, 2) * odds**2 / 2)  # of two differing bits, half the time each has one set
    tables, each = ceil(log(1 - MET) / log(1 - met)), 64 // width
    lanes = max(8, ceil(tables / each) + 2)
    segments = tuple(Segment(k // each, k % each * width, width, 1) for k in range(tables))
    near = [int(64 * x * ANGLE + 4 * sqrt(64 * x * ANGLE * (1 - ANGLE))) for x in (lanes, 2)]
    return Index(lanes, segments, near[0], 2, near[1])


def _lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(hashes + U(0x9E3779B97F4A7C15 * lane & (1 << 64) - 1)) if lane else hashes


def _fingerprints(shingle: int) -> Callable[[], Callable[[pa.RecordBatch], dict]]:
    def work() -> Callable[[pa.RecordBatch], dict]:
        def one(batch: pa.RecordBatch) -> dict:
            found = [np.zeros(0, U)]
            for _, texts in pieces(batch):
                words = Words([t.lower() for t in texts])  # bytes.lower() changes A-Z alone
                hashes, per = _hashes(words, shingle)
                found.append(majority_bits(hashes, per))
            return {"doc_id": batch.column("doc_id"), "f0": pa.array(np.concatenate(found).view(np.int64))}

        return one

    return work


def _hashes(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the shingles, number of each text)."""
    firsts, per = words.runs(shingle)
    last = firsts + shingle - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
    if len(short):  # the whole sequence
        at = np.searchsorted(firsts, words.bounds[short])
        firsts, last = np.insert(firsts, at, words.bounds[short]), np.insert(last, at, words.bounds[short + 1] - 1)
        per[short] = 1
    return (xxh64_spans(words.raw, words.starts[firsts], words.ends[last]) if len(firsts) else np.zeros(0, U)), per


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and f0 (a long, the fingerprint's bits)."""
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return map_batches(slim, "doc_id long, f0 long", _fingerprints(shingle))


def _bits(a: str, b: str, words: list[str]) -> Column:
    return reduce(add, (F.bit_count(F.col(f"{a}{x}").bitwiseXOR(F.col(f"{b}{x}"))) for x in words))


def _filed(nodes: DataFrame, index: Index, *columns: str, with_own: bool = False) -> DataFrame:
    """(columns, key): a row for each value of the ball around each segment. Keys of sets filed by their shingles are negative.
    own: the segment's value itself; two fingerprints that meet in a segment do so under own | own, among other keys.
    Joins of these ask for a merge: Spark's estimate of their size doesn't know how many rows the ball makes."""
    segment = [F.shiftrightunsigned(F.col(f"f{s.lane}"), s.shift).bitwiseAND((1 << s.width) - 1).bitwiseOR(F.lit(n << 40)) for n, s in enumerate(index.segments)]
    segment = F.array(*segment)
    if "short" in nodes.columns:
        segment = F.when(F.col("long"), F.concat(segment, "short")).otherwise(F.col("short"))
    rows = nodes.select(*columns, F.explode(segment).alias("own"))
    own, balls = F.col("own"), [F.col("own")]
    n = F.shiftright(own, 40)
    for radius in range(1, 1 + max(s.radius for s in index.segments)):
        having = [(k, s.width) for k, s in enumerate(index.segments) if s.radius >= radius]
        for mask, top in [(1 << a, a) for a in range(max(w for _, w in having))] if radius == 1 else [(1 << a | 1 << b, a) for a in range(max(w for _, w in having)) for b in range(a)]:
            within = [k for k, w in having if top < w]
            here = (own >= 0) if len(within) == len(index.segments) else n.isin(within)
            balls.append(F.when(here & (own.bitwiseAND(mask) == 0), own.bitwiseOR(F.lit(mask))))
    return rows.select(*columns, *(["own"] if with_own else []), F.explode(F.array(*balls)).alias("key")).where("key is not null")


def _as(rows: DataFrame, prefix: str, *kept: str) -> DataFrame:
    return rows.select(*(F.col(c).alias(c if c in kept else f"{prefix}_{c}") for c in rows.columns))


def _with_another(filed: DataFrame, on: Callable[[str, str], Column]) -> DataFrame:
    """The rows of `filed` (key, columns) for which there is one of the same key so that on("u.", "v.") holds. Spark moves
    them once for both sides: they keep their names and their order, key last, so neither side has a projection of its own."""
    u, v = filed.alias("u"), filed.alias("v")
    return u.join(v.hint("merge"), (F.col("u.key") == F.col("v.key")) & on("u.", "v."), "left_semi")


def links(nodes: DataFrame, index: Index, confirm: Callable[[DataFrame], DataFrame] | None = None, payload: tuple[str, ...] = (), likely: Callable[[str, str], Column] | None = None) -> DataFrame | None:
    """Edges (u, v) whose components are those of all linked pairs, or None if there are none.

    nodes: a written table of node, f0, ... of different fingerprints; with short (keys of its own) and long (whether segments
    count, too), if both are there. confirm: the linked ones of a table of pairs (u, v); by
    default all that are within the index's distance. payload, likely: columns of nodes, and a condition on them, with
    the prefixes of both sides given, that refuses pairs before they are written down.
    """
    sketch = [f"f{k}" for k in range(index.lanes - index.sketch, index.lanes)]
    key = F.col("key")
    same = key == F.col("u_own").bitwiseOR(F.col("v_own"))  # one key for a segment that two have in common

    def near(bits: Column, side: str = "") -> Column:
        return (F.col(f"{side}key") < 0) | (bits <= index.most_sketch)

    between = _bits("u_", "v_", sketch)
    there = reduce(lambda a, b: a & b, (F.col(x).isNotNull() for x in sketch))  # as a join further on would ask of one side alone
    prints = nodes.where(there).groupBy(*sketch, *(c for c in ("short", "long") if c in nodes.columns), *sorted({f"f{s.lane}" for s in index.segments} - set(sketch))).agg(F.count("*").alias("n"))
    filed = _filed(prints, index, *sketch)
    some = _with_another(filed, lambda u, v: reduce(lambda a, b: a | b, (F.col(f"{u}{x}") != F.col(f"{v}{x}") for x in sketch)) & near(_bits(u, v, sketch), u))
    alike = prints.groupBy(*sketch).agg(F.sum("n").alias("n")).where("n > 1").select(*sketch)
    some = some.select(*sketch).union(alike)
    now = materialise(nodes.join(some.distinct(), sketch, "left_semi").withColumn("part", F.col("node")), "neighbours")
    if payload and likely is not None:  # a member of a dense group finds another at once, so this looks at few of its pairs
        rows = _filed(now.where("node is not null"), index, "node", *payload, with_own=True)

        def like(u: str, v: str) -> Column:
            meet = F.col(f"{u}key") == F.col(f"{u}own").bitwiseOR(F.col(f"{v}own"))
            return meet & (F.col(f"{u}node") != F.col(f"{v}node")) & near(_bits(u, v, sketch), u) & likely(u, v)

        now = materialise(now.join(_with_another(rows, like).select("node").distinct(), "node", "left_semi"), "neighbours")
    if now.isEmpty():
        return None
    edges: list[DataFrame] = []
    for turn in range(ROUNDS):
        rows = _filed(now, index, "node", "part", *sketch, with_own=True)
        held = ("own", "node", "part", *sketch)
        heads = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), *held)).alias("m"), F.min("part").alias("lo"), F.max("part").alias("hi"))
        heads = heads.where("lo <> hi").select("key", *(F.col(f"m.{c}").alias(f"v_{c}") for c in held))
        met = _as(rows, "u", "key").join(heads.hint("merge"), "key").where((F.col("u_part") != F.col("v_part")) & same & near(between))
        nearest = met.groupBy("u_node").agg(F.min(F.struct(between.alias("bits"), "v_node")).alias("m"))
        nearest = nearest.select(F.col("u_node").alias("u"), F.col("m.v_node").alias("v"))
        edges.append(confirm(nearest) if confirm else materialise(nearest, "stars"))
        now = materialise(_in_parts(now, edges), "parts")
    rows = _filed(now, index, "node", "part", *sketch)
    heads = rows.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.min(F.struct(F.xxhash64("part").alias("h"), "part")).alias("m"))
    heads = materialise(heads.where("lo <> hi").select("key", F.col("m.part").alias("head")), "heads")
    apart = (F.col("u_part") != F.col("v_part")) & near(between)
    if payload:
        placed = materialise(rows.join(heads.hint("merge"), "key"), "placed")
        u, v = _as(placed.where("part <> head"), "u", "key"), _as(placed, "v", "key").withColumnRenamed("key", "v_key").hint("merge")
        on = (key == F.col("v_key")) & apart
        one = u.join(v, on, "left_semi").select(F.col("u_node").alias("node"))
        u, v = _as(placed.where("part = head"), "u", "key"), _as(placed.where("part <> head"), "v", "key").withColumnRenamed("key", "v_key").hint("merge")
        other = u.join(v, on, "left_semi").select(F.col("u_node").alias("node"))
        now = materialise(now.join(one.union(other).distinct(), "node", "left_semi"), "neighbours")
        release(placed)
    rows = _filed(now, index, "node", "part", *dict.fromkeys((*sketch, *payload)), with_own=True)
    placed = rows.join(heads.hint("merge"), "key")
    u, v = _as(placed.where("part <> head").drop("head"), "u", "key"), _as(placed, "v", "key")
    once = (F.col("v_part") == F.col("v_head")) | (F.col("u_node") > F.col("v_node"))  # else both are found by the other, too
    met = u.join(v.hint("merge"), "key").where(apart & once & same & (F.lit(True) if likely is None else likely("u_", "v_")))
    met = met.select(F.greatest("u_node", "v_node").alias("u"), F.least("u_node", "v_node").alias("v")).distinct()
    edges.append(confirm(met) if confirm else materialise(met, "links"))
    return reduce(DataFrame.union, edges)


def _in_parts(nodes: DataFrame, edges: list[DataFrame]) -> DataFrame:
    of = connected_components(reduce(DataFrame.union, edges)).select("node", F.col("component").alias("part"))
    return nodes.drop("part").join(of, "node", "left").withColumn("part", F.coalesce("part", "node"))


def near_duplicates(prints: DataFrame, index: Index | None = None) -> DataFrame:
    """doc_id, f0, component_id for every row of `prints` (doc_id, f0), which should be a written table. All within 4 bits are
    linked."""
    distinct = materialise(prints.where("doc_id is not null").groupBy("f0").agg(F.min("doc_id").alias("least")), "distinct")
    distinct = distinct.withColumn("node", F.col("f0"))
    edges = links(distinct, index or exact_index(distinct.count()))
    if edges is None:
        of = distinct.select(F.col("f0").alias("of_f0"), F.col("least").alias("component_id"))
    else:
        parts = materialise(distinct.join(connected_components(edges), "node", "left").select("f0", "least", F.coalesce("component", "node").alias("part")), "print-parts")
        least = parts.groupBy("part").agg(F.min("least").alias("component_id"))
        of = materialise(parts.join(least, "part").select(F.col("f0").alias("of_f0"), "component_id"), "of-prints")
    return prints.join(of, (prints["f0"] == of["of_f0"]) & prints["doc_id"].isNotNull(), "left").select("doc_id", "f0", "component_id")


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The hashes of each text's distinct shingles, in ascending order."""
    hashes, per = _hashes(Words([t.lower() for t in texts]), shingle)
    cuts = np.concatenate([[0], np.cumsum(per)])
    return [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _node(shingles: np.ndarray) -> int:
    """64 bits that stand for a set. Two of n sets clash with odds of n * n / 2 ** 65."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _prints(shingle: int, lanes: int) -> Callable[[], Callable[[pa.RecordBatch], dict]]:
    most, least = SIMILAR[1], SIMILAR[1] - SIMILAR[0]

    def work() -> Callable[[pa.RecordBatch], dict]:
        def one(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"node": [], "size": [], "short": []}
            words: list[np.ndarray] = []
            for _, texts in pieces(batch, 1_000_000):
                sets = shingle_sets(texts, shingle)
                size = np.array([len(s) for s in sets], np.int64)
                every = np.concatenate(sets)
                fp = [majority_bits(_lane(every, k), size) for k in range(lanes)]
                odd = np.zeros(len(sets) * 64 * PARITY, np.uint8)
                odd[: len(odd)] = np.bincount(np.repeat(np.arange(len(sets)), size) * (64 * PARITY) + (every >> U(64 - (64 * PARITY).bit_length() + 1)).astype(np.int64), minlength=len(odd)) & 1
                words.append(np.concatenate([np.stack(fp, axis=1), np.packbits(odd.reshape(len(sets), -1), axis=1).view(U)], axis=1))
                out["node"] += [_node(s) for s in sets]
                out["size"] += size.tolist()
                # sets of a and b shingles as similar as 4/5 share one of the first a // 5 + 1 and b // 5 + 1 in any one order;
                # the larger is of LONG at most, so both are filed here, or of more, so both have more than SHORT
                out["short"] += [(s[: least * len(s) // most + 1] | U(1 << 63)).view(np.int64) if len(s) <= LONG else s[:0].view(np.int64) for s in sets]
            bits = np.concatenate(words).view(np.int64)
            names = [f"f{k}" for k in range(lanes)] + [f"o{k}" for k in range(PARITY)]
            return {"doc_id": batch.column("doc_id"), "sha": batch.column("sha"), **out, **{n: pa.array(bits[:, k]) for k, n in enumerate(names)}}

        return one

    return work


def _sets(shingle: int) -> Callable[[], Callable[[pa.RecordBatch], dict]]:
    def work() -> Callable[[pa.RecordBatch], dict]:
        def one(batch: pa.RecordBatch) -> dict:
            sets = [s for _, texts in pieces(batch, 1_000_000) for s in shingle_sets(texts, shingle)]
            return {"doc_id": batch.column("doc_id"), "node": [_node(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]}

        return one

    return work


def _sha(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)


def similar_links(docs: DataFrame, prints: DataFrame, shingle: int = 5) -> DataFrame | None:
    """Edges (u, v) between nodes of `prints` (a written table of _prints over docs: doc_id, text, sha), all similar; their
    components are those of all similar pairs."""
    lanes = sum(c[0] == "f" and c[1:].isdigit() for c in prints.columns)
    sketches = [*(f"f{k}" for k in range(lanes)), *(f"o{k}" for k in range(PARITY))]
    columns = ["size", "short", *sketches]
    nodes = materialise(prints.groupBy("node").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in columns)), "sets")
    nodes = nodes.withColumn("long", F.col("size") > SHORT)
    index = similar_index(nodes.count())
    a, b = SIMILAR

    def likely(u: str, v: str) -> Column:
        u_size, v_size = F.col(f"{u}size"), F.col(f"{v}size")
        odd = _bits(u, v, sketches[lanes:]) * (a + b) <= (u_size + v_size) * (b - a)
        return odd & ((F.greatest(u_size, v_size) <= LONG) | (_bits(u, v, sketches[: index.lanes]) <= index.most))

    slim = nodes.select("node", "size", *sketches)

    def confirm(pairs: DataFrame) -> DataFrame:
        for x in ("u", "v"):
            pairs = pairs.join(_as(slim, x).withColumnRenamed(f"{x}_node", x), x)
        close = materialise(pairs.where(likely("u_", "v_")).select("u", "v"), "candidates")
        if close.isEmpty():
            return close
        wanted = materialise(close.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(nodes.select("node", "doc_id"), "node"), "wanted")
        few, _ = parted(docs, wanted.select("doc_id"))
        sets = map_batches(few.select("doc_id", "text"), "doc_id long, node long, shingles array<long>", _sets(shingle))
        sets = materialise(sets.join(wanted, ["doc_id", "node"], "left_semi").dropDuplicates(["node"]).select("node", "shingles"), "sets")
        both = close.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("us")), "u").join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("vs")), "v")
        shared, total = F.size(F.array_intersect("us", "vs")), F.size("us") + F.size("vs")
        found = materialise(both.where(shared * (a + b) >= total * a).select("u", "v"), "links")
        release(close, wanted, sets)
        return found

    return links(nodes, index, confirm, ("size", *sketches), likely)


def _lanes_for(n: int) -> int:
    return similar_index(n).lanes


def keep_one(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one document of each group; see the module's text."""
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text").withColumn("sha", _sha("text")).where("doc_id is not null")
    lanes = _lanes_for(slim.count())
    words = ", ".join(f"{x}{k} long" for x, n in (("f", lanes), ("o", PARITY)) for k in range(n))
    prints = materialise(map_batches(slim, f"doc_id long, sha string, node long, size long, short array<long>, {words}", _prints(shingle, lanes)), "prints")
    edges = similar_links(slim, prints, shingle)
    parts = connected_components(edges) if edges is not None else docs.sparkSession.createDataFrame([], "node long, component long")
    rows = materialise(prints.select("doc_id", "sha", "node").join(parts, "node", "left").select("doc_id", "sha", F.coalesce("component", "node").alias("part")), "rows")
    best = rows.groupBy("part").agg(F.min(F.struct("doc_id", "sha")).alias("best"))
    gone = rows.join(best, "part").where((F.col("doc_id") != F.col("best.doc_id")) | (F.col("sha") != F.col("best.sha")))
    gone = materialise(gone.select(F.col("doc_id").alias("gone_id"), F.col("sha").alias("gone_sha")).distinct(), "gone")
    few, rest = parted(docs, gone.select("gone_id"), id_col)
    return rest.union(few.join(gone, (few[f"`{id_col}`"] == gone["gone_id"]) & (_sha(text_col) == gone["gone_sha"]), "left_anti"))
