"""Benchmark decontamination: pigeonhole seeds, exact bounds, exact edit verification of every seeded window.

Words: lower-cased stretches of ASCII letters, digits and non-ASCII characters. An item is leaked into a text if some stretch
of the text's words has a word edit distance to the whole item of at most (1 - SIMILARITY) of the item's words, rounded down.

1. Seeds. If an item is within d edits of a stretch, one of any d + 1 disjoint pieces of it stands there unchanged. Texts
   are searched for the items' pieces by rolling hashes; the stretch lies within d words of where a piece points.
2. Bounds. Within d edits all but d of the item's words stand in that window, and all but d of them are words of the item.
   Windows that have fewer are left; the others are united where they overlap.
3. Verification. Bit-parallel edit distance (Myers) decides for every window left, of any length; the stretch itself is
   found by the plain recurrence.

No step loses a leak, and clean texts are never reported by chance. (A CGK embedding with bit sampling stood between 1 and 3;
its recall fell with the item's length, and the bounds are cheaper.)

Items are held in blocks of at most BLOCK_WORDS words; each block is one broadcast of bounded size and one pass. Items of
fewer than five words must stand word for word; `least` can leave out the shortest.

Defined cases: null texts and items are empty, and report nothing; a null item_id is reported as such; repeated rows and
repeated items are all reported; of equally near stretches the one met first counts; texts of any length are searched whole;
columns of any name are carried on; no rows, or no items, give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, only, shares, trim
from .kernels import U, Words, _ranges, rolling, xxh64_spans
from .licenses import _WORD

SIMILARITY, LEAST_WORDS, BLOCK_WORDS = 0.8, 1, 1_000_000
SLOTS = 1 << 20


def plain(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(_WORD)


def within(places: dict[int, int], n: int, d: int, text: list[int]) -> bool:
    """Whether an item of n words is within d edits of any stretch of the text; places: word: bits of its places in the item."""
    met = 0
    for word in text:
        met |= places.get(word, 0)
    if met.bit_count() < n - d:
        return False
    every, last = (1 << n) - 1, 1 << (n - 1)
    up, down, cost = every, 0, n
    for word in text:
        same = places.get(word, 0)
        diagonal = same | down
        across = ((same & up) + up ^ up) | same
        more, less = down | (every & ~(across | up)), up & across
        if more & last:
            cost += 1
        elif less & last:
            cost -= 1
            if cost <= d:
                return True
        more, less = more << 1, less << 1
        up, down = every & (less | ~(diagonal | more)), more & diagonal & every
    return False


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(least word edit distance of the item to any stretch of the text, the stretch's start, its end)."""
    m = len(text)
    places = np.arange(m + 1)
    row, start = np.zeros(m + 1, np.int64), places.copy()
    for k, word in enumerate(item, 1):
        swap = np.concatenate([[1 << 40], row[:-1] + (text != word)])
        drop = row + 1
        best = np.where(swap <= drop, swap, drop)
        origin = np.where(swap <= drop, np.concatenate([[0], start[:-1]]), start)
        best[0], origin[0] = k, 0
        run = best - places  # a word of the text too many costs one
        least = np.minimum.accumulate(run)
        from_ = np.maximum.accumulate(np.where(run == least, places, 0))
        row, start = least + places, origin[from_]
    end = int(row.argmin())
    return int(row[end]), int(start[end]), end


@dataclass
class Items:
    """One block of items, ready to search for."""

    ids: list[int | None] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    edits: list[int] = field(default_factory=list)
    #: of each item: its distinct words, sorted; word: bits of its places
    vocabulary: list[np.ndarray] = field(default_factory=list)
    places: list[dict[int, int]] = field(default_factory=list)
    #: piece length: (hashes, sorted; places of pieces in their items; the items; filter)
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    @staticmethod
    def of(rows: list[tuple[int | None, str | None]], similarity: float = SIMILARITY, least: int = LEAST_WORDS) -> Items:
        out = Items()
        held = Words([plain(t) for _, t in rows])
        hashes = xxh64_spans(held.raw, held.starts, held.ends)
        found: dict[int, set] = defaultdict(set)
        for k, (item_id, _) in enumerate(rows):
            w = hashes[held.bounds[k] : held.bounds[k + 1]]
            if len(w) < least:
                continue
            out.ids.append(item_id)
            out.words.append(w)
            d = int((1 - similarity) * len(w) + 1e-9)
            out.edits.append(d)
            q = len(w) // (d + 1)
            places = np.arange(d + 1) * q
            found[q].update(zip(rolling(w, places, q).tolist(), places.tolist(), [len(out.ids) - 1] * (d + 1), strict=True))
            bits: dict[int, int] = defaultdict(int)
            for at, word in enumerate(w.tolist()):
                bits[word] |= 1 << at
            out.places.append(dict(bits))
            out.vocabulary.append(np.unique(w))
        for q, of in found.items():
            h, place, item = (np.array(v, kind) for v, kind in zip(zip(*sorted(of), strict=True), (U, np.int64, np.int64), strict=True))
            seen = np.zeros(SLOTS, bool)
            seen[h & U(SLOTS - 1)] = True
            out.pieces[q] = h, place, item, seen
        return out

    def windows(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, starts of its places under some piece) for one text's word hashes; some may start before it."""
        items, starts = [], []
        for q, (have, place, item, seen) in self.pieces.items():
            if len(hashes) < q:
                continue
            runs = rolling(hashes, np.arange(len(hashes) - q + 1), q)
            at = np.flatnonzero(seen[runs & U(SLOTS - 1)])
            lo, hi = np.searchsorted(have, runs[at], "left"), np.searchsorted(have, runs[at], "right")
            which = _ranges(lo, hi - lo)
            items.append(item[which])
            starts.append(np.repeat(at, hi - lo) - place[which])
        if items and len(every := np.concatenate(items)):
            order = np.argsort(every, kind="stable")
            every, of = every[order], np.concatenate(starts)[order]
            cuts = np.flatnonzero(np.diff(every)) + 1
            for k, own in zip(every[np.concatenate([[0], cuts])].tolist(), np.split(of, cuts), strict=True):
                yield k, np.unique(own)

    def search(self, hashes: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """Item: (distance, start, end) of its best stretch in the text, for the items that leaked."""
        best: dict[int, tuple[int, int, int]] = {}
        for k, starts in self.windows(hashes):
            n, d = len(self.words[k]), self.edits[k]
            lo, hi = np.maximum(starts - d, 0), np.minimum(starts + n + d, len(hashes))
            have = self.vocabulary[k]
            known = np.concatenate([[0], np.cumsum(have[np.minimum(np.searchsorted(have, hashes), len(have) - 1)] == hashes)])
            some = known[hi] - known[lo] >= n - d
            lo, hi = lo[some], hi[some]
            if not len(lo):
                continue
            apart = np.flatnonzero(lo[1:] >= hi[:-1]) + 1
            for a, b in zip(lo[np.concatenate([[0], apart])].tolist(), hi[np.concatenate([apart - 1, [-1]])].tolist(), strict=True):
                if within(self.places[k], n, d, hashes[a:b].tolist()):
                    cost, first, end = distance(self.words[k], hashes[a:b])
                    if k not in best or cost < best[k][0]:
                        best[k] = cost, a + first, a + end
                    if not cost:
                        break
        return best


def blocks(benchmark: DataFrame, similarity: float = SIMILARITY, id_col: str = "item_id", text_col: str = "text", most: int = BLOCK_WORDS, least: int = LEAST_WORDS) -> Iterator[Items]:
    """The benchmark in blocks of at most `most` words (one item at least), read one partition at a time."""
    held, size = [], 0
    for row in only(benchmark, item_id=id_col, text=text_col).toLocalIterator():
        n = len(plain(row["text"]).split())
        if held and size + n > most:
            yield Items.of(held, similarity, least)
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += n
    if held:
        yield Items.of(held, similarity, least)


def _texts(batch: pa.RecordBatch, column: int, budget: int = 4_000_000) -> Iterator[tuple[int, list[bytes]]]:
    held, first, size = [], 0, 0
    for k, value in enumerate(batch.column(column)):
        raw = plain(value.as_py())
        if held and size + len(raw) > budget:
            yield first, held
            held, first, size = [], k, 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def _found(items: Items, batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, dict[int, tuple[int, int, int]]]]:
    """(row, leaks) of the rows with any."""
    for first, texts in _texts(batch, column):
        words = Words(texts)
        hashes = xxh64_spans(words.raw, words.starts, words.ends)
        for k in range(len(texts)):
            if got := items.search(hashes[words.bounds[k] : words.bounds[k + 1]]):
                yield first + k, got


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, least: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, start_word, n_words, distance, item_words: one row for each document and item that leaked into it."""
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, item_id long, start_word long, n_words long, distance long, item_words long"

    def task(shared: Broadcast) -> Callable[[], Callable[[pa.RecordBatch], dict]]:
        def work() -> Callable[[pa.RecordBatch], dict]:
            items = shared.value

            def one(batch: pa.RecordBatch) -> dict:
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[row], items.ids[k], a, b - a, cost, len(items.words[k])) for row, got in _found(items, batch, 1) for k, (cost, a, b) in got.items()]
                return dict(zip(("doc_id", "item_id", "start_word", "n_words", "distance", "item_words"), zip(*rows, strict=True) if rows else [[]] * 6, strict=True))

            return one

        return work

    context = docs.sparkSession.sparkContext
    parts = [map_batches(slim, schema, task(context.broadcast(block))) for block in blocks(benchmark, similarity, least=least)]
    found = slim.sparkSession.createDataFrame([], schema) if not parts else parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, least: int = LEAST_WORDS, text_col: str = "text") -> DataFrame:
    """The rows of docs into which no item leaked, judged where they lie."""
    column = docs.columns.index(text_col)
    context = docs.sparkSession.sparkContext
    for block in blocks(benchmark, similarity, least=least):
        shared = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            for batch in (x for whole in batches for x in shares(whole, 2_000_000)):
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, _ in _found(shared.value, batch, column)]] = False
                yield batch.filter(pa.array(keep))
                trim()

        docs = docs.mapInArrow(run, docs.schema)
    return docs
