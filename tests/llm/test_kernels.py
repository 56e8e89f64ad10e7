import random

import numpy as np
import xxhash

from factweave.llm import kernels as K


def test_spans_hash_like_the_library():
    rnd = random.Random(3)
    raw = bytes(rnd.randrange(256) for _ in range(5000))
    spans = [(a, a + n) for n in [*range(0, 140), 500, 1000] for a in (0, rnd.randrange(3900))]
    s, e = (np.array(x) for x in zip(*spans, strict=True))
    for seed in (0, 42):
        assert K.xxh64_spans(raw, s, e, seed).tolist() == [xxhash.xxh64_intdigest(raw[a:b], seed) for a, b in spans]
    assert K.xxh64_spans(raw, s[:0], e[:0]).tolist() == []


def test_words_cut_at_ascii_space_only():
    w = K.Words([b"", b" a\tbb\x0b\n ", "c d e".encode(), b"   ", b"f"])
    assert w.counts.tolist() == [0, 2, 2, 0, 1]
    assert [w.raw[a:b] for a, b in zip(w.starts, w.ends, strict=True)] == [b"a", b"bb", "c d".encode(), b"e", b"f"]
    firsts, per = w.runs(2)
    assert firsts.tolist() == [0, 2] and per.tolist() == [0, 1, 1, 0, 0]


def test_rolling_depends_on_content_only():
    v = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    h = K.rolling(v, np.arange(5), 3).tolist()
    assert h[0] == h[3] and len(set(h)) == 4


def test_majority_bits_against_counting():
    rnd = np.random.default_rng(1)
    sizes = np.array([0, 1, 2, 255, 256, 700, 0, 3])
    hashes = rnd.integers(0, 1 << 63, int(sizes.sum()), dtype=np.uint64) * np.uint64(2)
    got, at = K.majority_bits(hashes, sizes).tolist(), 0
    for n, g in zip(sizes, got, strict=True):
        part = hashes[at : at + n].tolist()
        at += n
        assert g == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in part) > n)
