import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st

from factweave.llm import bpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = B.read_ranks(PATH)
    return B.Bpe(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["", " ", "  ", "a  b", " lead", "trail ", "a\n\nb", "a\nb c", "x\x1c\x1cy \x85z", "don't we'll I'm", "<|endoftext|>", "漢字かな 한국어 🙂🙂", "é" * 50, "ab" * 3000, "0" * 999, " \t x", "é 　q"]


@pytest.mark.parametrize("text", ODD)
def test_like_the_library(both, text):
    mine, lib = both
    for _ in range(2):
        ids, bounds = mine.encode(pa.array(["x y", text, None, text]))
        want = lib.encode_ordinary(text)
        assert [x.tolist() for x in np.split(ids, bounds[1:-1])] == [lib.encode_ordinary("x y"), want, [], want]
    assert mine.whole(text).tolist() == want
    assert b"".join(mine.decode(mine.whole(text)).to_pylist()) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])), st.text("ab é\n\t'.1"))
def test_any_text(both, one, two):
    mine, lib = both
    texts = [one, two, one + " " + two]
    ids, bounds = mine.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, bounds[1:-1])] == [lib.encode_ordinary(t) for t in texts]


def test_memo_starts_anew_without_changing_results(both):
    ranks = B.read_ranks(PATH)
    small = B.Bpe(ranks, P.PATTERN)
    small.pieces.most = small.parts.most = 3
    pieces = small.pieces
    rnd = random.Random(1)
    text = " ".join(rnd.choice(["alpha", "beta", "gamma,", "delta.", "x\ny"]) for _ in range(300))
    for _ in range(2):
        assert small.encode(pa.array([text]))[0].tolist() == both[1].encode_ordinary(text)
    assert len(pieces) <= 3


def test_unknown_bytes_and_ids(both):
    tiny = B.Bpe({b"a": 0, b"b": 1, b"ab": 2}, P.PATTERN)
    assert tiny.merge(b"abab") == [2, 2] and tiny.merge(b"aab") == [0, 2]
    for bad in (lambda: tiny.merge(b"z"), lambda: tiny.merge(b"abz"), lambda: tiny.decode(np.array([9]))):
        with pytest.raises(ValueError):
            bad()


def test_pieces_are_merged_together(both, monkeypatch):
    mine = B.Bpe(both[0].ranks, P.PATTERN)
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeilnorstuxéß漢🙂'") for _ in range(rnd.randrange(1, 9))) for _ in range(20_000)]
    slow, merge = [], mine.merge
    monkeypatch.setattr(mine, "merge", lambda raw: slow.append(raw) or merge(raw))
    ids, bounds = mine.encode(pa.array([" ".join(words), "ab" * 40, "a" * 31 + " " + "a" * 32 + " " + "a" * 33]))
    want = [both[1].encode_ordinary(t) for t in (" ".join(words), "ab" * 40, "a" * 31 + " " + "a" * 32 + " " + "a" * 33)]
    assert [x.tolist() for x in np.split(ids, bounds[1:-1])] == want
    assert {len(raw) > B.SHORT for raw in slow} == {True}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcé", min_size=1, max_size=50), max_size=40, unique=True))
def test_together_as_one_by_one(pieces):
    """Also where a byte is no token of its own, and where a token can't be reached by merging."""
    for tokens in (b"a b c ab bc abc ca cabca aa aaaa \xc3\xa9 \xc3 \xa9".split(), b"a b c ab ba \xc3\xa9 a\xc3\xa9".split()):
        bpe = B.Bpe({raw: k for k, raw in enumerate(tokens)}, P.PATTERN)
        ids, count = bpe.merge_all(pa.array(pieces, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])][: len(pieces)] == [bpe.merge(x.encode()) for x in pieces]


def test_memory_of_a_batch_is_bounded(both):
    """Six megabytes of words that are all new, as one batch."""
    rnd = random.Random(7)
    texts = [" ".join("".join(rnd.choices("abcdeilnorstu", k=8)) for _ in range(1300)) for _ in range(500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(500)), "text": texts})
    work = B._each_run(PATH, P.PATTERN, B._digests)()
    tracemalloc.start()
    try:
        got = work(batch)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got["n_tokens"][:3] == [len(both[1].encode_ordinary(x)) for x in texts[:3]]
    assert peak < 90e6, peak


def test_dataframes(spark, both):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "null id"), (3, None), (3, None)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id int, text string, n_tokens int")
    encoded = B.encode(docs, PATH, P.PATTERN)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((r.doc_id, r.text) for r in B.decode(encoded, PATH, P.PATTERN).collect() if r.doc_id not in (None, 3)) == sorted(r for r in rows if r[0] not in (None, 3))
    import hashlib

    want = []
    for i, t in rows:
        ids = both[1].encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, B.round_trip(docs, PATH, P.PATTERN).collect()), key=key) == sorted(want, key=key)
    assert B.round_trip(docs.limit(0), PATH, P.PATTERN, with_ids=True).count() == 0
