"""Substring dedup with a log-structured fingerprint index.

A window is some consecutive words (`[^\\x20\\x09-\\x0D]+`) of one text. A word goes if a window that covers it has a word
sequence that also starts anywhere else, in the same text or another; windows are judged on the input.

Each window is filed under one fingerprint: the smallest (then leftmost) hash among its runs of half a window. It depends on
the window's words alone, so equal windows have equal fingerprints at equal places, and neighbouring windows mostly share
one: about one place in ten is indexed.

The index is a set of sorted immutable runs (fingerprint, places), bucketed and sorted by fingerprint, so a new batch, once
sorted alike, is merge-joined with each of them without moving them. What meets a run, or itself, is a hit. More than FANOUT
runs are compacted into one. Hits are candidates: the windows under them are compared by 128-bit hashes of their whole word
sequences, each count exact. Texts with the same word sequence are one candidate with a weight.

Defined cases: null is the empty text; texts shorter than a window keep all words; repeated rows are copies of each other,
whatever their ids; null ids are kept; no rows give no rows.
"""

from __future__ import annotations

import atexit
import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, map_batches, materialise, only, pieces
from .kernels import BASES, Words, _ranges, rolling, xxh64_spans

WINDOW, FANOUT = 35, 4


class FingerprintIndex:
    """Sorted runs of (fp, n): fingerprints of all batches so far and the number of places they have."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        """buckets: those of every run; by default as many as a shuffle has partitions, so each bucket is one file."""
        self.spark, self.fanout, self.buckets = spark, fanout, buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[tuple[str, str]] = []
        self.name = f"fingerprint_runs_{uuid.uuid4().hex}"
        self.made = 0
        atexit.register(self.drop)

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name, path = f"{self.name}_{self.made}", fresh_path(self.spark, "fingerprint-run")
        self.made += 1
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            rows = rows.repartition(self.buckets, "fp")  # else the aggregation has dealt them out alike
        rows.write.bucketBy(self.buckets, "fp").sortBy("fp").option("path", path).saveAsTable(name)
        return name, path

    def rows(self, run: tuple[str, str]) -> DataFrame:
        """A run's rows without its buckets: Spark 4.1 takes a union of bucketed scans for bucketed, but then reads it by file."""
        return self.spark.read.schema("fp long, n long").parquet(run[1])

    def add(self, places: DataFrame) -> DataFrame:
        """Takes a batch, one row (fp) for each place, and returns the fingerprints (fp) that have another place, in this
        batch or in an earlier one. The batch becomes a run."""
        new = self._write(places.groupBy("fp").agg(F.count("*").alias("n")))
        hits = [self.rows(new).where("n > 1").select("fp")]
        hits += [materialise(self.spark.table(new[0]).join(self.spark.table(run[0]).hint("merge"), "fp").select("fp"), "hits") for run in self.runs]
        self.runs.append(new)
        return materialise(reduce(DataFrame.union, hits).distinct(), "hits")

    def compact(self) -> None:
        """Merges all runs into one if there are more than the fan-out."""
        if len(self.runs) <= self.fanout:
            return
        old = self.runs
        self.runs = [self._write(reduce(DataFrame.union, map(self.rows, old)).groupBy("fp").agg(F.sum("n").alias("n")))]
        for name, _ in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def drop(self) -> None:
        runs, self.runs = self.runs, []
        if self.spark.getActiveSession() is not None:  # else the catalog has gone with the session
            for name, _ in runs:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _least(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window: (its first word in the batch, place of its fingerprint, fingerprint)."""
    half = (window + 1) // 2
    firsts, per = words.runs(half)
    hashes = rolling(xxh64_spans(words.raw, words.starts, words.ends), firsts, half) if len(firsts) else np.zeros(0, np.uint64)
    span = window - half + 1
    windows = np.maximum(per - span + 1, 0)
    at = _ranges(np.concatenate([[0], np.cumsum(per)[:-1]]), windows)
    if not len(at):
        return at, at, hashes[:0]
    place = at + np.lib.stride_tricks.sliding_window_view(hashes, span)[at].argmin(axis=1)
    return firsts[at], firsts[place], hashes[place]


def _measure(window: int) -> Callable[[], Callable[[pa.RecordBatch], dict]]:
    def work() -> Callable[[pa.RecordBatch], dict]:
        def one(batch: pa.RecordBatch) -> dict:
            n_words, sha, fps = [], [], []
            for _, texts in pieces(batch):
                words = Words(texts)
                sha += [hashlib.sha256(x).digest() for x in words.raw[:-1].split(b"\n")]
                n_words += words.counts.tolist()
                _, place, fp = _least(words, window)
                new = np.concatenate([[True], place[1:] != place[:-1]]) if len(place) else np.zeros(0, bool)
                place, fp = place[new], fp[new].view(np.int64)
                cuts = np.searchsorted(place, words.bounds)
                fps += [fp[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return {"doc_id": batch.column("doc_id"), "n_words": n_words, "sha": sha, "fps": fps}

        return one

    return work


def _windows(window: int) -> Callable[[], Callable[[pa.RecordBatch], dict]]:
    def work() -> Callable[[pa.RecordBatch], dict]:
        def one(batch: pa.RecordBatch) -> dict | None:
            sha, hot, weight, key = (batch.column(c).to_pylist() for c in ("sha", "hot", "weight", "key"))
            out: dict[str, list] = {k: [] for k in ("w1", "w2", "key", "start", "weight")}
            for at, texts in pieces(batch):
                words = Words(texts)
                first, _, fp = _least(words, window)
                if not len(first):
                    continue
                cuts = np.searchsorted(first, words.bounds)
                keep = np.zeros(len(first), bool)
                own = [hashlib.sha256(x).digest() for x in words.raw[:-1].split(b"\n")]
                for k in range(len(texts)):
                    if own[k] == sha[at + k] and cuts[k + 1] > cuts[k]:  # else another text with the same id
                        keep[cuts[k] : cuts[k + 1]] = np.isin(fp[cuts[k] : cuts[k + 1]], np.array(hot[at + k], np.int64).view(np.uint64))
                first, row = first[keep], np.repeat(np.arange(len(texts)), np.diff(cuts))[keep]
                for name, seed, base in (("w1", 42, BASES[0]), ("w2", 43, BASES[1])):
                    out[name].append(rolling(xxh64_spans(words.raw, words.starts, words.ends, seed), first, window, base).view(np.int64))
                out["key"].append(np.array(key[at : at + len(texts)], np.int64)[row])
                out["weight"].append(np.array(weight[at : at + len(texts)], np.int64)[row])
                out["start"].append((first - words.bounds[row]).astype(np.int32))
            return {k: np.concatenate(v) for k, v in out.items()} if out["w1"] else None

        return one

    return work


def _remove(window: int) -> Callable[[], Callable[[pa.RecordBatch], dict]]:
    def work() -> Callable[[pa.RecordBatch], dict]:
        def one(batch: pa.RecordBatch) -> dict | None:
            out: dict[str, list] = {k: [] for k in ("sha", "n_removed", "kept_sha256", "spans")}
            for text, sha, starts in zip(batch.column("text"), batch.column("sha").to_pylist(), batch.column("starts").to_pylist(), strict=True):
                words = (text.as_py() or "").encode().split()
                if hashlib.sha256(b" ".join(words)).digest() != sha:
                    continue
                mark = np.zeros(len(words) + 1, np.int64)
                at = np.array(starts, np.int64)
                np.add.at(mark, at, 1)
                np.add.at(mark, at + window, -1)
                gone = np.cumsum(mark[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2)
                out["sha"].append(sha)
                out["n_removed"].append(int(gone.sum()))
                out["kept_sha256"].append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])).hexdigest())
                out["spans"].append([{"start": int(a), "end": int(b)} for a, b in edges])
            return out if out["sha"] else None

        return one

    return work


def repeated(docs: DataFrame, window: int = WINDOW, batches: int = 2, index: FingerprintIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (of removed words, from 0, end exclusive) for every row of docs.

    The corpus enters the index in `batches` parts, as it would day by day. kept_sha256 is that of the kept words joined by
    one space.
    """
    spark = docs.sparkSession
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    rows = materialise(map_batches(slim, "doc_id long, n_words long, sha binary, fps array<long>", _measure(window)).withColumn("rid", F.monotonically_increasing_id()), "texts")
    index = index or FingerprintIndex(spark)
    hits = []
    for k in range(batches):
        hits.append(index.add(rows.where(F.pmod("rid", F.lit(batches)) == k).select(F.explode("fps").alias("fp"))))
        index.compact()
    hot = materialise(reduce(DataFrame.union, hits).distinct(), "hot")
    groups = materialise(rows.where(f"n_words >= {window}").groupBy("sha").agg(F.count("*").alias("weight"), F.min("rid").alias("rid")), "groups")
    firsts = groups.select("rid", "weight").join(rows.select("rid", "doc_id", "sha", "fps"), "rid")
    met = firsts.select("rid", F.explode("fps").alias("fp")).join(hot, "fp").groupBy("rid").agg(F.collect_set("fp").alias("hot"))
    chosen = met.join(firsts.select("rid", "weight", "sha", F.col("doc_id").alias("of")), "rid")
    texts = slim.join(chosen, slim["doc_id"].eqNullSafe(chosen["of"])).select(F.col("rid").alias("key"), "sha", "weight", "hot", "text")
    texts = materialise(texts, "candidates")
    schema = "w1 long, w2 long, key long, start int, weight long"
    counted = map_batches(texts, schema, _windows(window)).groupBy("w1", "w2").agg(F.sum("weight").alias("n")).where("n > 1").select("w1", "w2")
    single = texts.where("weight = 1")  # a text with copies goes as a whole
    found = map_batches(single, schema, _windows(window)).select("w1", "w2", "key", "start").join(materialise(counted, "windows"), ["w1", "w2"], "left_semi")
    starts = found.groupBy("key").agg(F.collect_list("start").alias("starts"))  # no more than the text has words
    partly = map_batches(single.select("key", "sha", "text").join(starts, "key"), "sha binary, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>", _remove(window)).dropDuplicates(["sha"])
    partly = materialise(partly, "partly")
    whole = groups.where("weight > 1").select("sha", F.lit(True).alias("whole"))
    nothing = hashlib.sha256(b"").hexdigest()
    judged = rows.select("doc_id", "n_words", "sha").join(materialise(whole, "whole"), "sha", "left").join(partly, "sha", "left")
    return judged.select(
        "doc_id",
        "n_words",
        F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("whole"), F.lit(nothing)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
        F.when(F.col("whole"), F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))).otherwise(F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"))).alias("spans"),
    )
