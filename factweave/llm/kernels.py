"""numpy kernels over batches of texts: word spans, XXH64 of spans, rolling hashes of word runs."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Primes of the public XXH64 definition. Fixed values.
P1, P2, P3, P4, P5 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every output bit depends on every input bit (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _rot(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U(by)) | (x >> U(64 - by))


def xxh64_spans(raw: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of raw[start:end] for each span, all spans side by side.

    Spans are put in order of length, so that those that still have a lane to read are always a suffix.
    """
    n = len(starts)
    if not n:
        return np.zeros(0, U)
    padded = np.frombuffer(raw + bytes(40), np.uint8)
    lane = np.ndarray(len(padded) - 7, "<u8", padded, 0, (1,))  # unaligned reads at every byte
    half = np.ndarray(len(padded) - 3, "<u4", padded, 0, (1,))
    order = np.argsort(ends - starts, kind="stable")
    at, length = starts[order].astype(np.int64), (ends - starts)[order].astype(np.int64)
    seed_ = U(seed)
    with np.errstate(over="ignore"):
        h = np.full(n, seed_ + P5, U)
        first = int(np.searchsorted(length, 32))
        if first < n:
            acc = [np.full(n - first, v, U) for v in (seed_ + P1 + P2, seed_ + P2, seed_, seed_ - P1)]
            pos, left = at[first:].copy(), length[first:].copy()
            lo = 0
            while lo < len(pos):
                for k in range(4):
                    acc[k][lo:] = _rot(acc[k][lo:] + lane[pos[lo:] + 8 * k] * P2, 31) * P1
                pos[lo:] += 32
                left[lo:] -= 32
                # by length, those that go on are a suffix still
                lo = lo + int(np.searchsorted(left[lo:], 32))
            wide = _rot(acc[0], 1) + _rot(acc[1], 7) + _rot(acc[2], 12) + _rot(acc[3], 18)
            for v in acc:
                wide = (wide ^ (_rot(v * P2, 31) * P1)) * P1 + P4
            h[first:] = wide
            at = at.copy()
            at[first:] = pos
        h += length.astype(U)
        left = length & 31
        for step in range(3):
            who = np.flatnonzero(left >= 8 * (step + 1))
            if not len(who):
                break
            k = _rot(lane[at[who] + 8 * step] * P2, 31) * P1
            h[who] = _rot(h[who] ^ k, 27) * P1 + P4
        at = at + (left & ~7)
        left = left & 7
        if len(who := np.flatnonzero(left >= 4)):
            h[who] = _rot(h[who] ^ (half[at[who]].astype(U) * P1), 23) * P2 + P3
            at[who] += 4
        left = left & 3
        for step in range(3):
            who = np.flatnonzero(left > step)
            if not len(who):
                break
            h[who] = _rot(h[who] ^ (padded[at[who] + step].astype(U) * P5), 11) * P1
        h = (h ^ (h >> U(33))) * P2
        h = (h ^ (h >> U(29))) * P3
        h = h ^ (h >> U(32))
    out = np.empty(n, U)
    out[order] = h
    return out


class Words:
    """The words of some texts, joined by single spaces in one buffer; a line feed follows each text.

    raw: the buffer. starts, ends: of each word. text_of: bounds of each text's words, one more than there are texts.
    """

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]  # bytes.split() cuts at exactly 0x20 and 0x09 to 0x0D
        self.raw = b"\n".join(map(b" ".join, split)) + b"\n"
        self.counts = np.fromiter(map(len, split), np.int64, len(split))
        self.bounds = np.concatenate([[0], np.cumsum(self.counts)])
        buffer = np.frombuffer(self.raw, np.uint8)
        cuts = np.flatnonzero((buffer == 32) | (buffer == 10))
        before = np.concatenate([[-1], cuts[:-1]])
        some = cuts - before > 1  # an empty text leaves only its line feed
        self.starts, self.ends = (before + 1)[some], cuts[some]

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word of each run of k words, number of runs of each text); runs don't cross texts."""
        per = np.maximum(self.counts - k + 1, 0)
        return _ranges(self.bounds[:-1], per), per


def _ranges(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenation of range(first, first + size)."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = sizes > 0
    firsts, sizes = firsts[keep], sizes[keep]
    steps = np.ones(total, np.int64)
    steps[0] = firsts[0]
    steps[np.cumsum(sizes)[:-1]] = firsts[1:] - (firsts[:-1] + sizes[:-1] - 1)
    return np.cumsum(steps)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Odd multipliers of the two independent rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        have = tuple(np.cumprod(np.concatenate([[U(1)], np.full(size - 1, U(b), U)]), dtype=U) for b in (base, pow(base, -1, 1 << 64)))
        _POWERS[base] = have
    return have


def rolling(values: np.ndarray, firsts: np.ndarray, k: int, base: int = BASES[0]) -> np.ndarray:
    """A 64-bit hash of values[f : f + k] for each f, by differences of one prefix sum."""
    up, down = _powers(base, len(values) + 1)
    with np.errstate(over="ignore"):
        prefix = np.concatenate([[U(0)], np.cumsum(values * up[: len(values)], dtype=U)])
        return mix((prefix[firsts + k] - prefix[firsts]) * down[firsts])


_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").reshape(256)


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each group of hashes (they lie one after the other) the 64-bit number whose bit is 1 where more than half have it."""
    out = np.zeros(len(sizes), U)
    some = np.flatnonzero(sizes > 0)
    if not len(some):
        return out
    sizes = sizes[some].astype(np.int64)
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # byte lanes hold counts up to 255: sum in slabs of at most that many hashes, then sum the slabs
    slabs = -(-sizes // 255)
    slab_of = np.repeat(np.arange(len(sizes)), slabs)
    nth = np.arange(int(slabs.sum())) - np.repeat(np.concatenate([[0], np.cumsum(slabs)[:-1]]), slabs)
    slab_first = firsts[slab_of] + nth * 255
    total = np.zeros((len(sizes), 64), np.int64)
    slab_bounds = np.concatenate([[0], np.cumsum(slabs)[:-1]])
    lanes = hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    for lane in range(8):
        summed = np.add.reduceat(_SPREAD[lanes[:, lane]], slab_first)
        wide = summed.view(np.uint8).reshape(-1, 8).astype(np.int64)
        total[:, 8 * lane : 8 * lane + 8] = np.add.reduceat(wide, slab_bounds, axis=0)
    bits = (2 * total > sizes[:, None]).astype(np.uint8)
    out[some] = np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out
