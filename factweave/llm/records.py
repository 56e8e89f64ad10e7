"""Token ids in length-delimited binary records, with a separate offset index.

A file is a run of records. A record, all integers little-endian:

    8 bytes  length of the body
    4 bytes  masked checksum of those 8 bytes
    body     8 bytes doc_id, 1 byte flags (bit 0: doc_id is null), 1 byte width of an id (2 or 4), then the ids
    4 bytes  masked checksum of the body
    1 byte   0x0A

A checksum is CRC-32 (that of zlib), masked by a rotation to the right by 15 bits and the addition of 0xA282EAD8, so that
checksums of data that hold checksums stay useful. Spark's own text writer, which ends each row with 0x0A, writes the files:
any store that Spark writes to will do, and its commit protocol covers lost executors and repeated attempts.

Files lie in folders shard=N, by ranges of doc_id; in the order of (shard, file name) the records ascend by doc_id, null
first. An id that very many rows share, null as well, has several shards. A file holds at most RECORDS_PER_FILE records; where
texts are so long that this could make more than FILE_BYTES, folders part=N below the shard bound its bytes, too. So reading a
file whole takes bounded memory. The index (Parquet) has for each record its shard, file, byte offset, byte length, doc_id,
number of ids and place in its file, for reads in any order; it is made by reading the files, which verifies both checksums
of every record.

Defined cases: null counts as the empty text, which has the end id alone; one text may take as many bytes as Spark can hold in
a value (2 GB) and then fills a file; repeated doc_ids keep all their records, in the order of their checksums and bytes;
columns of any name besides the two are left alone; no rows give no files, and then an empty index.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, only
from .kernels import _ranges
from .parts import Parts, runs

#: Records in a file at most, and bytes besides those of its longest record.
RECORDS_PER_FILE, FILE_BYTES = 2048, 1 << 29
#: Documents in a shard, about; there are never more than MOST_SHARDS, whose bounds the driver holds.
DOCS_PER_SHARD = 4096
MOST_SHARDS = 20_000
HEAD = struct.Struct("<QI")
START = struct.Struct("<qBB")


class Damaged(ValueError):
    """A record whose length or checksum is wrong."""


def masked(raw: bytes) -> int:
    crc = zlib.crc32(raw)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = ids.dtype.itemsize
    body = START.pack(doc_id or 0, doc_id is None, wide) + ids.tobytes()
    size = struct.pack("<Q", len(body))
    return b"".join((size, struct.pack("<I", masked(size)), body, struct.pack("<I", masked(body)), b"\n"))


def unframe(raw: bytes | memoryview, at: int = 0) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids, offset of the next record) of the record at an offset."""
    raw = memoryview(raw)
    if at + HEAD.size > len(raw):
        raise Damaged(f"cut off at {at}")
    size, crc = HEAD.unpack_from(raw, at)
    if masked(raw[at : at + 8]) != crc:
        raise Damaged(f"length at {at}")
    end = at + HEAD.size + size
    if end + 5 > len(raw) or raw[end + 4] != 10:
        raise Damaged(f"cut off at {at}")
    body = raw[at + HEAD.size : end]
    if masked(body) != struct.unpack_from("<I", raw, end)[0]:
        raise Damaged(f"body at {at}")
    doc_id, null, wide = START.unpack_from(body)
    return None if null else doc_id, np.frombuffer(body[START.size :], f"<u{wide}"), end + 5


def unframe_all(raw: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length, doc_id, ids) of every record."""
    at = 0
    while at < len(raw):
        doc_id, ids, after = unframe(raw, at)
        yield at, after - at, doc_id, ids
        at = after


#: What a character of a piece can be: its class by code point, UNSURE from the end of the table on.
UNSURE, LETTER, NUMBER, OTHER, SPACE, LINE = range(6)
CLASSES = np.array([{"L": LETTER, "N": NUMBER, "P": OTHER, "S": OTHER}.get(unicodedata.category(chr(k))[0], UNSURE) for k in range(0x250)] + [UNSURE], np.uint8)
CLASSES[[32, 10, 39]] = SPACE, LINE, UNSURE  # an apostrophe may begin a contraction


_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The character that stands for each byte in byte-level vocabularies: itself if it is printable, else one from 256 on.
AS_CHARACTERS = {b: 256 + n for n, b in enumerate(sorted(set(range(256)).difference(_SHOWN)))}


def cut(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Whether a piece of the GPT-2 pattern begins at each character (a code point) of some parts, whose first ones are given.
    They have no UNSURE one, a space at the start alone, and no two neighbouring white-space characters."""
    kind = CLASSES[points]
    begins = np.ones(len(kind), bool)
    begins[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != SPACE)
    begins[firsts] = True
    return begins


class Encoder:
    """The tokenizers library, called with add_special_tokens=False and otherwise as it is, so the strings of special tokens in
    a text become their ids; as_text=True takes them for ordinary text. Recurring parts are asked for once (see parts)."""

    def __init__(self, path: str, end_id: int | None, as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = as_text
        self.kind = np.dtype("<u2" if max(self.lib.get_vocab_size() - 1, end_id or 0) < 1 << 16 else "<u4")
        self.end = np.array([] if end_id is None else [end_id], self.kind)
        line = self.lib.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        added = tuple(t.content for t in self.lib.get_added_tokens_decoder().values())
        self.parts = Parts(self._learn, self.whole, self.kind, added)
        #: pieces are asked of the library's model alone, where its pre-tokenizer is known to make the pieces of cut()
        like = json.loads(self.lib.to_str())
        before, model = like["pre_tokenizer"] or {}, like["model"]
        plain = like["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        self.model = self.lib.model if plain and model["type"] == "BPE" and not model["dropout"] and like["truncation"] is like["padding"] is None else None
        self.pieces = Parts(self._ask, self.whole, self.kind)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, self.kind)

    def _learn(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Most strings by way of their pieces, which recur more than they do; those with unsure characters whole."""
        if self.model is None:
            return self._learn_whole(strings)
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        points = np.minimum(np.frombuffer("".join(strings).encode("utf-32-le"), "<u4"), len(CLASSES) - 1)
        doubts = np.concatenate([[0], np.cumsum(CLASSES[points] == UNSURE)])
        ends = np.cumsum(size)
        sure = doubts[ends] == doubts[ends - size]
        rest = np.flatnonzero(~sure)
        some = [strings[k] for k in np.flatnonzero(sure).tolist()]
        points, size = points[np.repeat(sure, size)], size[sure]
        ends = np.cumsum(size)
        begins = np.flatnonzero(cut(points, (ends - size)[size > 0]))
        at = np.concatenate([[0], np.cumsum(1 + (points >= 0x80))])[np.append(begins, len(points))]
        raw = pa.py_buffer("".join(some).encode())
        pieces = pa.Array.from_buffers(pa.string(), len(begins), [None, pa.py_buffer(at.astype(np.int32)), raw])
        ids, each = self.pieces.of(pieces)
        until = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(begins, np.concatenate([[0], ends]))]
        starts, sizes = np.empty(len(strings), np.int64), np.empty(len(strings), np.int64)
        starts[sure], sizes[sure] = until[:-1], np.diff(until)
        if len(rest):
            more, sizes[rest] = self._learn_whole([strings[k] for k in rest.tolist()])
            starts[rest] = len(ids) + np.cumsum(sizes[rest]) - sizes[rest]
            ids = np.concatenate([ids, more.astype(self.kind)])
        return ids[_ranges(starts, sizes)], sizes

    def _ask(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The model knows bytes as characters of its own; of the ASCII ones in pieces, only the space and the line feed differ."""
        known = [x.replace(" ", "\u0120") if x.isascii() and x != "\n" else x.encode().decode("latin-1").translate(AS_CHARACTERS) for x in pieces]
        ids = [[t.id for t in self.model.tokenize(x)] for x in known]
        return np.fromiter(chain.from_iterable(ids), self.kind), np.fromiter(map(len, ids), np.int64, len(ids))

    def _learn_whole(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Strings after a space are joined by line feeds, up to 2,000 in a call: a line feed is a token by itself there."""
        starts, sizes = np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int64)
        found, used = [np.zeros(0, self.kind)], 0
        joined = [k for k, x in enumerate(strings) if x[:1] == " " and len(x) > 1 and "\n" not in x and self.line is not None]
        for at in range(0, len(joined), 2000):
            some = joined[at : at + 2000]
            ids = np.array(self.lib.encode_batch_fast(["\n".join([strings[k] for k in some]) + "\n"], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(ids == self.line)
            if len(ends) != len(some):  # another vocabulary may join line feeds with what is beside them
                joined = joined[:at]
                break
            starts[some], sizes[some] = used + np.concatenate([[0], ends[:-1] + 1]), np.diff(ends, prepend=-1) - 1
            found.append(ids)
            used += len(ids)
        alone = sorted(set(range(len(strings))).difference(joined))
        for k, x in zip(alone, self.lib.encode_batch_fast([strings[k] for k in alone], add_special_tokens=False), strict=True):
            found.append(np.array(x.ids, self.kind))
            starts[k], sizes[k] = used, len(x.ids)
            used += len(x.ids)
        return np.concatenate(found)[_ranges(starts, sizes)], sizes

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, with the end id."""
        ids, bounds = self.parts.batch(texts)
        if len(self.end):
            ids = np.insert(ids, bounds[1:], self.end[0])
            bounds = bounds + np.arange(len(bounds))
        return np.split(ids, bounds[1:-1])


_LOADED: dict[tuple, Encoder] = {}


def load(path: str, end_id: int | None, as_text: bool = False) -> Encoder:
    """One for each process, with its memo."""
    if (path, end_id, as_text) not in _LOADED:
        _LOADED[path, end_id, as_text] = Encoder(path, end_id, as_text)
    return _LOADED[path, end_id, as_text]


def shard_of(ids: np.ndarray, null: np.ndarray, marks: np.ndarray, bounds: np.ndarray, null_shards: int) -> np.ndarray:
    """The shard of each record: null ids have the negative ones, dealt by ranges of their marks (32 bits each); others those
    between the bounds. An id that is several bounds at once has rows for several shards, dealt alike."""
    lo, hi = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    often = np.maximum(hi - lo, 1)
    shard = np.where(hi - lo > 1, lo + 1 + (marks * often >> 32), hi)
    return np.where(null, (marks * null_shards >> 32) - null_shards, shard)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, as_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text and writes the records below path."""
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    seen = slim.agg(F.count("*").alias("n"), F.count("doc_id").alias("ids"), F.max(F.octet_length("text")).alias("longest")).first()
    shards = max(1, min(MOST_SHARDS, -(-seen.ids // DOCS_PER_SHARD)))
    cuts = slim.agg(F.percentile_approx("doc_id", [k / shards for k in range(1, shards)], 10 * shards)).first()[0] if shards > 1 else None
    bounds = np.array(cuts or [], np.int64)
    null_shards = max(1, min(MOST_SHARDS, -(-(seen.n - seen.ids) // DOCS_PER_SHARD)))

    def work() -> Callable[[pa.RecordBatch], dict]:
        encoder = load(tokenizer, end_id, as_text)

        def one(batch: pa.RecordBatch) -> dict:
            doc_id, texts = batch.column("doc_id"), batch.column("text")
            null = doc_id.is_null().to_numpy(zero_copy_only=False)
            ids = doc_id.fill_null(0).to_numpy()
            tokens = [x for first, end in runs(texts) for x in encoder.batch(texts[first:end])]
            body = [frame(None if n else i, t) for i, n, t in zip(ids.tolist(), null.tolist(), tokens, strict=True)]
            marks = np.fromiter((struct.unpack_from("<I", x, len(x) - 5)[0] for x in body), np.int64, len(body))  # the body's checksum
            return {"shard": shard_of(ids, null, marks, bounds, null_shards), "doc_id": doc_id, "mark": marks, "body": body}

        return one

    framed = map_batches(slim, "shard int, doc_id long, mark long, body binary", work).repartition("shard")
    order, folders = ["doc_id", "mark", "body"], ["shard"]
    if 4 * (seen.longest or 0) * RECORDS_PER_FILE > FILE_BYTES:  # else no file can be longer
        before = Window.partitionBy("shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        framed = framed.withColumn("part", F.floor(F.sum(F.octet_length("body")).over(before) / FILE_BYTES).cast("int"))
        folders.append("part")
    # the body's last byte is the writer's line feed
    rows = framed.sortWithinPartitions(*folders, *order).select(*folders, F.expr("cast(substring(body, 1, octet_length(body) - 1) as string)").alias("value"))
    rows.write.option("maxRecordsPerFile", RECORDS_PER_FILE).partitionBy(*folders).mode("overwrite").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    for folder in ("shard", "part"):
        if folder not in read.columns:  # no document, or no file that needs parts
            read = read.withColumn(folder, F.lit(0))
    name = F.concat(F.lpad(F.col("part").cast("string"), 9, "0"), F.lit("/"), F.element_at(F.split("path", "/"), -1))
    return read.select(F.col("shard").cast("int").alias("shard"), name.alias("file"), "content")


def build_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Reads and verifies every record, writes the offset index and returns it."""

    def work() -> Callable[[pa.RecordBatch], dict]:
        def one(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("shard", "file", "offset", "length", "doc_id", "start_in_file", "n_tokens", "ids_crc32")}
            for shard, file, content in zip(batch.column("shard").to_pylist(), batch.column("file").to_pylist(), batch.column("content"), strict=True):
                so_far = 0
                for row in unframe_all(content.as_buffer()):
                    ids = row[3]
                    for name, value in zip(out, (shard, file, *row[:3], so_far, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                        out[name].append(value)
                    so_far += len(ids)
            return out

        return one

    rows = map_batches(_files(spark, path), "shard int, file string, offset long, length long, doc_id long, start_in_file long, n_tokens long, ids_crc32 long", work)
    rows.write.mode("overwrite").parquet(index_path)
    return spark.read.schema(rows.schema).parquet(index_path)


def with_starts(index: DataFrame) -> DataFrame:
    """The index with `start`: the ids of all records before. Sums by file and shard; the shards are at most MOST_SHARDS."""
    files = index.groupBy("shard", "file").agg(F.sum("n_tokens").alias("n"))
    shards = files.groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("shard", "file", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("file_start")).join(shards, "shard")
    return index.join(files, ["shard", "file"]).withColumn("start", F.col("shard_start") + F.col("file_start") + F.col("start_in_file"))


def read(spark: SparkSession, path: str, index: DataFrame | None = None) -> DataFrame:
    """doc_id, ids (array<int>) of the records; with an index only those it lists, found by their offsets."""

    def work() -> Callable[[pa.RecordBatch], dict]:
        def one(batch: pa.RecordBatch) -> dict:
            ids, tokens = [], []
            for content, at in zip(batch.column("content"), batch.column("offsets").to_pylist(), strict=True):
                raw = content.as_buffer()
                for doc_id, got in ((r[2], r[3]) for r in unframe_all(raw)) if at is None else (unframe(raw, k)[:2] for k in at):
                    ids.append(doc_id)
                    tokens.append(got.astype(np.int32))
            return {"doc_id": ids, "ids": tokens}

        return one

    files = _files(spark, path)
    if index is None:
        files = files.withColumn("offsets", F.lit(None).cast("array<long>"))
    else:  # a file has RECORDS_PER_FILE records at most, which bounds each list
        files = files.join(index.groupBy("shard", "file").agg(F.collect_list("offset").alias("offsets")), ["shard", "file"])
    return map_batches(files.select("content", "offsets"), "doc_id long, ids array<int>", work)
