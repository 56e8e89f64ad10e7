import numpy as np
import pytest

from factweave.llm import langid as L
from factweave.llm import queries as Q

SF = "/root/testdata/sf0.01"


def test_codewords_tell_languages_apart():
    assert L.codewords(1).shape == (1, 0)
    for k in (2, 3, 4, 6, 9, 20):
        code = L.codewords(k)
        apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
        assert code.shape[0] == k and min(apart) >= max(1, 2 ** (k - 2) if k <= 6 else 10)


def test_blocks_count_like_the_whole(monkeypatch):
    text = "Ein Satz, über 3 Dinge -- und  noch\n einer. " * 30
    whole = L.counts(text)
    for block in (1, 7, 100):
        monkeypatch.setattr(L, "BLOCK", block)
        assert np.array_equal(L.counts(text), whole)
    assert L.counts("12 ... \n") is None and L.counts("") is None and L.counts("1é") is not None


def test_one_wrong_bit_is_corrected():
    m = L.Model(list("abcd"), L.codewords(4), np.zeros((1, 7)), np.ones(7))
    for k in range(4):
        for flip in range(7):
            margins = (2 * m.code[k] - 1) * 4.0
            margins[flip] *= -0.9
            assert m.decode(margins)[0] == "abcd"[k]
    assert m.decode(np.zeros(7))[::2] == ("a", True)


def test_held_out_accuracy(spark):
    got = Q.op1_langid(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("lang is not null and lang_pred <> 'und'").toPandas()
    assert len(got) > 900 and got.score.between(0, 1).all()
    for part in (got, got[got.held_out]):
        assert (part.lang == part.lang_pred).mean() > 0.97


def test_odd_rows(spark):
    rows = [(1, None, "en", "x"), (2, "", "en", "x"), (3, "12 !!", None, "x"), (None, "the cat", "en", "x"), (4, "the cat sat", "en", "x"), (4, "le chat noir", "fr", "x"), (5, "the", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = L.train(docs)
    got = [tuple(r) for r in L.identify(docs, model).orderBy("doc_id", "lang_pred").collect()]
    assert [g[1] for g in got] == ["en", "und", "und", "und", "en", "fr", "en"]
    assert {g[1:3] for g in map(tuple, L.identify(docs, L.train(docs.where("lang is null"))).collect())} == {("und", 0.0)}
    assert {g[1:3] for g in map(tuple, L.identify(docs, L.train(docs.where("lang = 'fr'"))).collect())} == {("und", 0.0), ("fr", 1.0)}
    assert L.identify(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("n", [7])
def test_many_languages(n):
    rnd = np.random.default_rng(0)
    alphabets = ["".join(chr(0x100 + 40 * k + j) for j in range(30)) for k in range(n)]
    texts = [["".join(rnd.choice(list(a + " "), 80)) for _ in range(6)] for a in alphabets]
    m = L.build({str(k): sum(L.counts(t) for t in texts[k][:3]) for k in range(n)})
    assert all(m.decode(m.margins(L.counts(t)))[0] == str(k) for k in range(n) for t in texts[k][3:])
