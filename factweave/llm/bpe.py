"""Byte-level BPE encoding and decoding, with a segment tree over byte positions.

A text is cut by the tokenizer's pattern; each piece that isn't a token itself is merged. Leaf i of the tree holds the rank
of the pair whose left part starts at byte i, with i in its low bits, so the root is the leftmost pair of least rank. A
merge changes three leaves at most: the pair's own, that of the part it swallowed, and that of the live neighbour before
it; each is a point update of logarithmic cost, so a piece of n bytes takes O(n log n) however long it is.

Short pieces are merged together by the same rule, column by column of an array: each round merges the leftmost pair of
least rank in every piece that has one (see _merge_short).

Most pieces repeat. Each worker process keeps a bounded memo of the parts of texts (see parts), and of pieces of the texts that
can't be cut into parts; neither ever changes a result.

Defined cases: null counts as the empty text, which has no tokens; lone bytes that form no token of their own, an id that
the vocabulary lacks: ValueError; repeated rows and ids are encoded row by row; no rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, only
from .kernels import _ranges
from .parts import Parts, runs

#: More than any rank with a position.
NONE = 1 << 62
#: Pieces that a worker process remembers; about 200 bytes each.
MEMO = 60_000
#: Bytes of the longest pieces that are merged together, and how many at once: their arrays stay in the processor's cache.
SHORT, TOGETHER = 32, 8192
#: Bytes of texts encoded at once, about: what is made on the way takes some 50 times as much in a worker process.
RUN = 1_000_000


class Memo(dict):
    """A dict that makes what is missing, and starts anew when it is full."""

    def __init__(self, make: Callable, most: int = MEMO):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        made = self.make(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = made
        return made


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Bpe:
    """ranks: token bytes to rank, which is its id. pattern: cuts a text into pieces that are encoded one by one."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.token = {rank: raw for raw, rank in ranks.items()}
        self.pieces = Memo(lambda piece: np.array(self.merge(piece.encode()), "<u4").tobytes())
        self.parts = Parts(self._learn, self.whole, np.dtype("<u4"))
        top = max(ranks.values(), default=-1) + 1
        self.decimal = pa.array([f"{k}," for k in range(top)], pa.large_string())
        self.bytes = pa.array([self.token.get(k) for k in range(top)], pa.large_binary())
        self.known, self.rank = pa.array(list(ranks), pa.binary()), np.fromiter(ranks.values(), np.int64, len(ranks))
        self.byte = np.array([ranks.get(bytes([k]), -1) for k in range(256)], np.int64)
        self.side = top
        pair, made, get = array("q", [NONE]), array("q", [NONE]), ranks.get
        for raw, rank in ranks.items():
            for k in range(1, len(raw)):
                if (left := get(raw[:k])) is not None and (right := get(raw[k:])) is not None:
                    pair.append(left * top + right)
                    made.append(rank)
        #: both parts' ids, sorted, and the rank of what they make together; the last fits none
        order = np.argsort(pair)
        self.pair, self.made = np.array(pair)[order], np.array(made)[order]

    def merge(self, raw: bytes) -> list[int]:
        """The ids of one piece."""
        ranks, n = self.ranks, len(raw)
        if (whole := ranks.get(raw)) is not None:
            return [whole]
        if n < 2:
            if n:
                raise ValueError(f"no token for byte {raw!r}")
            return []
        get = ranks.get
        size = 1 << (n - 2).bit_length()
        shift = size.bit_length()
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            if (rank := get(raw[i : i + 2])) is not None:
                tree[size + i] = rank << shift | i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        low = (1 << shift) - 1
        while (best := tree[1]) < NONE:
            i = best & low
            j = end[i]
            e = end[i] = end[j]
            changes = [(j, NONE)] if j < n - 1 else []
            if e < n:
                before[e] = i
                rank = get(raw[i : end[e]])
                changes.append((i, NONE if rank is None else rank << shift | i))
            else:
                changes.append((i, NONE))
            if (p := before[i]) >= 0:
                rank = get(raw[p:e])
                changes.append((p, NONE if rank is None else rank << shift | p))
            for at, value in changes:
                k = size + at
                tree[k] = value
                k >>= 1
                while k:
                    a, b = tree[2 * k], tree[2 * k + 1]
                    value = a if a < b else b
                    if tree[k] == value:
                        break
                    tree[k] = value
                    k >>= 1
        ids, i = [], 0
        while i < n:
            e = end[i]
            if (rank := get(raw[i:e])) is None:
                raise ValueError(f"no token for bytes {raw[i:e]!r}")
            ids.append(rank)
            i = e
        return ids

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of what two parts make together, or NONE."""
        key = left * self.side + right
        at = np.searchsorted(self.pair, key)
        return np.where(self.pair[at] == key, self.made[at], NONE)

    def _merge_short(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of 2 to SHORT bytes that are no tokens, one after the other, and the number of each.

        A piece is a column. Row i holds the part that starts at byte i and the pair it begins, as rank and place, so a column's
        least is its leftmost pair of least rank; a merge changes that row, the swallowed part's, and the live one before.
        """
        n, w = len(size), int(size.max())
        rows, columns = np.arange(w)[:, None], np.arange(n)
        ids = np.where(rows < size, self.byte[raw[np.minimum(start + rows, len(raw) - 1)]], -1)
        pair = np.full((w, n), NONE)
        made = self._made(ids[:-1], ids[1:])
        pair[:-1] = np.where((rows[1:] < size) & (made < NONE), made * SHORT + rows[:-1], NONE)
        after, before = np.repeat(rows + 1, n, 1), np.repeat(rows - 1, n, 1)
        ids, after, before = ids.ravel(), after.ravel(), before.ravel()
        while len(columns):
            best = pair.min(0)
            on = np.flatnonzero(best < NONE)
            if 2 * len(on) < len(columns):  # those that are done go
                pair, best, columns = np.ascontiguousarray(pair[:, on]), best[on], columns[on]
                on = np.arange(len(columns))
            best, column = best[on], columns[on]
            i, new = best % SHORT, best // SHORT
            here = i * n + column
            swallowed = after[here]
            end = after[swallowed * n + column]
            ids[here], ids[swallowed * n + column] = new, -1
            after[here] = end
            pair[swallowed, on] = NONE
            pair[i, on] = NONE
            go = np.flatnonzero(end < size[column])
            then = end[go] * n + column[go]
            before[then] = i[go]
            made = self._made(new[go], ids[then])
            pair[i[go], on[go]] = np.where(made < NONE, made * SHORT + i[go], NONE)
            p = before[here]
            go = np.flatnonzero(p >= 0)
            made = self._made(ids[p[go] * n + column[go]], new[go])
            pair[p[go], on[go]] = np.where(made < NONE, made * SHORT + p[go], NONE)
        ids = ids.reshape(w, n).T
        live = ids >= 0
        return ids[live], live.sum(1)

    def merge_all(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many pieces (strings), one after the other, and the number of each."""
        raw = pieces.cast(pa.binary())
        at = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1, 4 * raw.offset).astype(np.int64) if len(raw) else np.zeros(1, np.int64)
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8) if len(raw) else np.zeros(0, np.uint8)
        size, count = np.diff(at), np.ones(len(raw), np.int64)
        token = pc.fill_null(pc.index_in(raw, self.known), -1).to_numpy()
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(token >= 0), self.rank[token[token >= 0]])]
        lacks = np.concatenate([[0], np.cumsum(self.byte[data] < 0)])
        lacks = lacks[at[1:]] > lacks[at[:-1]]
        rest = token < 0
        short = np.flatnonzero(rest & (size > 1) & (size <= SHORT) & ~lacks)
        short = short[np.argsort(size[short], kind="stable")]
        for k in range(0, len(short), TOGETHER):
            these = short[k : k + TOGETHER]
            ids, count[these] = self._merge_short(data, at[these], size[these])
            out.append((these, ids))
        for k in np.flatnonzero(rest & ((size < 2) | (size > SHORT) | lacks)).tolist():
            ids = self.merge(raw[k].as_py())
            count[k] = len(ids)
            out.append((np.array([k]), np.array(ids, np.int64)))
        first = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), "<u4")
        for these, ids in out:
            flat[_ranges(first[these], count[these])] = ids
        return flat, count

    def whole(self, text: str) -> np.ndarray:
        """The ids of a text, piece by piece, as unsigned 32-bit integers."""
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.find(text))), "<u4")

    def _learn(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.find(x) for x in strings]
        bounds = np.cumsum([0, *map(len, found)])
        pieces = pa.array(chain.from_iterable(found), pa.string()).dictionary_encode()
        ids, count = self.merge_all(pieces.dictionary)
        which = pieces.indices.to_numpy()
        sizes = count[which]
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        return ids[_ranges((np.cumsum(count) - count)[which], sizes)], np.diff(ends)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; bounds of each text's)."""
        return self.parts.batch(texts)

    def decode(self, ids: np.ndarray) -> pa.Array:
        """The bytes of each id."""
        if len(ids) and (int(ids.max()) >= len(self.bytes) or int(ids.min()) < 0):
            raise ValueError("no token has such an id")
        raw = self.bytes.take(pa.array(ids))
        if raw.null_count:
            raise ValueError("no token has such an id")
        return raw


_LOADED: dict[tuple[str, str], Bpe] = {}


def load(path: str, pattern: str) -> Bpe:
    """One for each process, with its memos."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Bpe(read_ranks(path), pattern)
    return _LOADED[path, pattern]


def _each_run(path: str, pattern: str, one: Callable[[Bpe, np.ndarray, np.ndarray], dict]) -> Callable[[], Callable[[pa.RecordBatch], dict]]:
    def work() -> Callable[[pa.RecordBatch], dict]:
        bpe = load(path, pattern)

        def batch_of(batch: pa.RecordBatch) -> dict:
            texts, out = batch.column("text"), None
            for first, end in runs(texts, RUN):
                got = one(bpe, *bpe.encode(texts[first:end]))
                out = got if out is None else {k: [*out[k], *v] for k, v in got.items()}
            return {"doc_id": batch.column("doc_id")} | out

        return batch_of

    return work


def _lists(ids: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    return np.split(ids.astype(np.int32), bounds[1:-1])


def _joined(strings: pa.Array, bounds: np.ndarray, less: int = 0) -> list[memoryview]:
    """What strings[bounds[k]:bounds[k + 1]] have together, but for the last `less` bytes of each."""
    at = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1, 8 * strings.offset)[bounds].tolist()
    raw = memoryview(strings.buffers()[2] or b"")
    return [raw[a : max(a, b - less)] for a, b in zip(at[:-1], at[1:], strict=True)]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (array<int>)."""
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return map_batches(slim, "doc_id long, n_tokens long, ids array<int>", _each_run(path, pattern, lambda _, ids, at: {"n_tokens": np.diff(at), "ids": _lists(ids, at)}))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text (bytes that are no UTF-8 become U+FFFD; whole texts always are)."""

    def work() -> Callable[[pa.RecordBatch], dict]:
        bpe = load(path, pattern)
        return lambda batch: {"doc_id": batch.column("doc_id"), "text": [b"".join(bpe.decode(np.array(ids or [], np.int64)).to_pylist()).decode(errors="replace") for ids in batch.column("ids").to_pylist()]}

    return map_batches(encoded.select("doc_id", "ids"), "doc_id long, text string", work)


def _digests(bpe: Bpe, ids: np.ndarray, at: np.ndarray) -> dict:
    where = pa.array(ids)
    hashed = {"ids_sha256": _joined(bpe.decimal.take(where), at, 1), "decoded_sha256": _joined(bpe.decode(ids), at)}
    return {"n_tokens": np.diff(at)} | {k: [hashlib.sha256(x).hexdigest() for x in v] for k, v in hashed.items()}


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids): each text encoded and its ids decoded, in one pass.

    ids_sha256 is that of the decimal ids joined by commas, decoded_sha256 that of the bytes decoded from the ids.
    """
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        return map_batches(slim, schema + ", ids array<int>", _each_run(path, pattern, lambda b, ids, at: _digests(b, ids, at) | {"ids": _lists(ids, at)}))
    return map_batches(slim, schema, _each_run(path, pattern, _digests))
