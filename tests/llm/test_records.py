import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from factweave.llm import records as R

PATH = P.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a  b", "<|endoftext|> x", "a\nb c\n", "x\x1c \x85 y", "don't stop, we'll see. " * 40, "漢字 かな🙂 é", "one two\n\nthree", " \n", "a\n b"]


@pytest.fixture(scope="module")
def lib():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def test_round_trip_of_files(spark, lib, tmp_path):
    rnd = random.Random(4)
    words = ["alpha", "beta,", "gam\nma", "delta.", "ÉTÉ", "x" * 40]
    rows = [(k * 3 % 1009 - 100, TEXTS[k % len(TEXTS)] if k % 3 else " ".join(rnd.choice(words) for _ in range(30))) for k in range(1009)] + [(None, "no id"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, shard int").repartition(5)
    old, R.DOCS_PER_SHARD, R.RECORDS_PER_FILE = (R.DOCS_PER_SHARD, R.RECORDS_PER_FILE), 300, 70
    try:
        R.write(docs, str(tmp_path / "r"), PATH)
    finally:
        R.DOCS_PER_SHARD, R.RECORDS_PER_FILE = old
    index = R.build_index(spark, str(tmp_path / "r"), str(tmp_path / "i"))
    got = sorted(R.with_starts(index).collect(), key=lambda r: r.start)
    want = sorted(((-(10**9) if i is None else i), lib(t)) for i, t in rows)
    assert len({r.shard for r in got}) == 5 and len({(r.shard, r.file) for r in got}) > 8
    at = 0
    for r, (i, ids) in zip(got, sorted(want, key=lambda w: w[0]), strict=True):
        assert (-(10**9) if r.doc_id is None else r.doc_id) == i and r.start == at
        if i != 5:
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += r.n_tokens
    back = {r.doc_id: r.ids for r in R.read(spark, str(tmp_path / "r")).collect()}
    assert all(back[i] == lib(t) for i, t in rows if i not in (None, 5))
    some = index.where("doc_id % 50 = 1")
    assert {r.doc_id: r.ids for r in R.read(spark, str(tmp_path / "r"), some).collect()} == {i: v for i, v in back.items() if i is not None and i % 50 == 1 and i >= 0}


def test_no_rows(spark, tmp_path):
    R.write(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "r"), PATH)
    assert R.with_starts(R.build_index(spark, str(tmp_path / "r"), str(tmp_path / "i"))).count() == 0


def test_damage_is_found():
    raw = R.frame(5, np.arange(9, dtype="<u2")) + R.frame(None, np.array([70000], "<u4"))
    assert [(d, i.tolist()) for _, _, d, i in R.unframe_all(raw)] == [(5, list(range(9))), (None, [70000])]
    for k in range(len(raw)):
        bad = bytearray(raw)
        bad[k] ^= 4
        with pytest.raises(R.Damaged):
            list(R.unframe_all(bytes(bad)))
    with pytest.raises(R.Damaged):
        list(R.unframe_all(raw[:-3]))


def test_memo_and_whole_texts_agree(lib):
    e = R.Encoder(PATH, 0)
    for t in TEXTS * 2:
        assert e.batch(pa.array([t], pa.string()))[0].tolist() == lib(t)
    e.parts.most = 2
    for _ in range(2):
        texts = ["a b c d e,", "c d f's g!?\u2028x", "a 'd, b-c 12th", " a b ", "a word, word. ß! x' y_"]
        assert [x.tolist() for x in e.batch(pa.array(texts))] == [lib(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])), st.text("ab é\n'.1"))
def test_any_text(lib, one, two):
    e = R.load(PATH, 0)
    texts = [one, two, f"x {one} {two} y"]
    assert [x.tolist() for x in e.batch(pa.array(texts))] == [lib(t) for t in texts]


def test_special_strings_are_as_the_plain_library_has_them():
    plain = Tokenizer.from_file(PATH)
    texts = pa.array(["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b c", "hello world"])
    assert [x.tolist() for x in R.Encoder(PATH, None).batch(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    assert 50256 in R.Encoder(PATH, None).batch(texts)[0]
    plain.encode_special_tokens = True
    assert [x.tolist() for x in R.Encoder(PATH, None, as_text=True).batch(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]


def test_long_texts_and_hot_ids_fill_several_files(spark, lib, tmp_path):
    rnd = random.Random(6)
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, " ".join(rnd.choice(["a", "bc", "d-e"]) for _ in range(rnd.randrange(3, 60)))) for k in range(600)] + [(8, "very long " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    old, R.DOCS_PER_SHARD, R.FILE_BYTES = (R.DOCS_PER_SHARD, R.FILE_BYTES), 50, 4000
    try:
        R.write(docs, str(tmp_path / "r"), PATH)
    finally:
        R.DOCS_PER_SHARD, R.FILE_BYTES = old
    got = sorted(R.with_starts(R.build_index(spark, str(tmp_path / "r"), str(tmp_path / "i"))).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [r.doc_id or -1 for r in got] == sorted(-1 if i is None else i for i, _ in rows)
    assert len({r.shard for r in got if r.doc_id is None}) > 2 and len({r.shard for r in got if r.doc_id == 7}) > 2
    size = {}
    for r in got:
        size.setdefault((r.shard, r.file), []).append(r.length)
    assert all(sum(x) - max(x) <= 4000 for x in size.values()) and max(map(max, size.values())) > 100_000 and len(size) > 15
    back = sorted(((-1 if r.doc_id is None else r.doc_id), r.ids) for r in R.read(spark, str(tmp_path / "r")).collect())
    assert back == sorted((-1 if i is None else i, lib(t)) for i, t in rows)


def test_parts_are_asked_for_by_their_pieces(lib):
    e = R.Encoder(PATH, 0)
    texts = [f"{a}{b}\n{c}{d} {c}{b}" for a in ("Ab", "éß", "x9") for b in (",", "...", "²", "¿") for c in ("word", "Über", "12") for d in ("!", "7", "-Z")]
    assert [x.tolist() for x in e.batch(pa.array(texts))] == [lib(t) for t in texts]
    assert 0 < len(e.pieces.start) < 40 < len(e.parts.start)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé 09²½,.'\n¿×ǅ\u00aa\u00a0\x85\t\x7fñß漢\u0345-_s$"), max_size=12), min_size=1, max_size=5))
def test_pieces_are_those_of_the_library(lib, texts):
    e = R.load(PATH, 0)
    assert [x.tolist() for x in e.batch(pa.array(texts, pa.string()))] == [lib(t) for t in texts]


def test_every_character_of_the_table_is_cut_as_the_library_cuts_it(lib):
    e = R.Encoder(PATH, 0)
    texts = [f"a{chr(k)}b 1{chr(k)}2 ,{chr(k)}; {chr(k)}" for k in range(0x260) if chr(k) != " "]
    assert [x.tolist() for x in e.batch(pa.array(texts))] == [lib(t) for t in texts]
