"""Token ids of whole batches of texts, by way of their recurring parts.

Texts without two neighbouring white-space characters are cut before each space: every piece of the GPT-2 pattern that holds
a space starts with it, so a part is tokenized alike wherever it stands. Arrow cuts the batch and numbers its different
parts; those that aren't known are tokenized; the ids of all are then gathered by numpy. What is remembered is bounded and
never changes a result: it is known by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .kernels import U, _ranges, xxh64_spans

#: Two neighbouring white-space characters, by the widest definition: a tokenizer's pattern may look across a space here.
TWO_SPACES = r"[\x09-\x0D\x1C-\x20\x85\pZ]{2}"
#: Parts remembered by a worker process, about; some 60 bytes each.
MEMO = 300_000


class Parts:
    """learn: token ids of some new strings, one after the other, and the number of each. whole: ids of a text that can't be cut.
    keep_whole: texts with one of these can't. most: parts that are remembered; when there are more, those go that were met
    once, and if that doesn't halve them, all."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], whole: Callable[[str], np.ndarray], kind: np.dtype, keep_whole: tuple[str, ...] = (), most: int = MEMO):
        self.learn, self.whole, self.kind, self.keep_whole, self.most = learn, whole, kind, keep_whole, most
        #: what is known, by two hashes of each part (other seeds for those at the start of a text than for those after a space)
        self.one, self.two, self.slot = np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64)
        self.flat, self.start, self.size, self.hits = np.zeros(0, kind), *(np.zeros(0, np.int64) for _ in range(3))

    def _forget(self) -> None:
        keep = self.hits > 1
        if 2 * int(keep.sum()) > self.most:
            keep[:] = False
        place, known = np.cumsum(keep) - 1, keep[self.slot]
        self.one, self.two, self.slot = self.one[known], self.two[known], place[self.slot[known]]
        self.start, self.size, self.hits = self.start[keep], self.size[keep], self.hits[keep] // 2
        self.flat = self.flat[_ranges(self.start, self.size)]
        self.start = np.cumsum(self.size) - self.size

    def _places(self, strings: pa.Array, space: str) -> np.ndarray:
        """The place of each of some different strings in the arrays; what isn't known is learnt."""
        at = np.frombuffer(strings.buffers()[1], np.int32, len(strings) + 1).astype(np.int64) if len(strings) else np.zeros(1, np.int64)
        raw = bytes(strings.buffers()[2] or b"") if len(strings) else b""
        one, two = (xxh64_spans(raw, at[:-1], at[1:], seed + len(space)) for seed in (42, 52))
        where = np.minimum(np.searchsorted(self.one, one), max(0, len(self.one) - 1))
        known = (self.one[where] == one) & (self.two[where] == two) if len(self.one) else np.zeros(len(one), bool)
        out = np.empty(len(one), np.int64)
        out[known] = self.slot[where[known]]
        if not known.all():
            ids, sizes = self.learn([space + x for x in strings.filter(pa.array(~known)).to_pylist()])
            out[~known] = np.arange(len(self.start), len(self.start) + len(sizes))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
            self.size, self.flat = np.concatenate([self.size, sizes]), np.concatenate([self.flat, ids.astype(self.kind)])
            self.hits = np.concatenate([self.hits, np.zeros(len(sizes), np.int64)])
            table = [np.concatenate(x) for x in ((self.one, one[~known]), (self.two, two[~known]), (self.slot, out[~known]))]
            order = np.argsort(table[0], kind="stable")
            self.one, self.two, self.slot = (x[order] for x in table)
        return out

    def of(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of some strings, one after the other; the number of each); none is cut."""
        held = strings.dictionary_encode()
        if len(self.start) + len(held.dictionary) > self.most:
            self._forget()
        of = self._places(held.dictionary, "")[held.indices.to_numpy()]
        self.hits += np.bincount(of, minlength=len(self.hits))
        return self.flat[_ranges(self.start[of], self.size[of])], self.size[of]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; bounds of each text's ids, one more than there are texts). Null: empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, TWO_SPACES)
        for special in self.keep_whole:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        flat = split.flatten()
        is_first = np.zeros(len(flat), bool)
        is_first[bounds[:-1]] = True
        both = [flat.filter(pa.array(x)).dictionary_encode() for x in (is_first, ~is_first)]
        if len(self.start) + sum(len(x.dictionary) for x in both) > self.most:
            self._forget()
        of = np.empty(len(flat), np.int64)
        for where, held, space in zip((is_first, ~is_first), both, ("", " "), strict=True):
            of[where] = self._places(held.dictionary, space)[held.indices.to_numpy()]
        self.hits += np.bincount(of, minlength=len(self.hits))
        sizes = self.size[of]
        ids = self.flat[_ranges(self.start[of], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(at):
            each = np.split(ids, ends[1:-1])
            for k in at.tolist():
                each[k] = self.whole(texts[k].as_py())
            ids, ends = np.concatenate(each).astype(self.kind, copy=False), np.concatenate([[0], np.cumsum([len(x) for x in each])])
        return ids, ends


def runs(texts: pa.Array, budget: int = 4_000_000) -> list[tuple[int, int]]:
    """(first, end) of runs of texts that have at most `budget` bytes together, or are one text."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    total, out, first = np.concatenate([[0], np.cumsum(size)]), [], 0
    while first < len(size):
        end = max(first + 1, int(np.searchsorted(total, total[first] + budget, "right")) - 1)
        out.append((first, end))
        first = end
    return out
