import hashlib
import random

import public_tokenizers as P
import tiktoken

import corpus_pipeline as C
from factweave.llm import bpe, quality, queries

SF = "/root/testdata/sf0.001"


def shingles(text, k=5):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def test_stages_against_plain_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    step = [docs]
    for _, f in C.STAGES[:-1]:
        step.append(f(spark, step[-1], SF))
    assert all(s.columns == docs.columns for s in step)
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in step]
    scores = {r.doc_id: r.score for r in queries.op10_quality(spark, SF).collect()}
    assert ids[1] == {i for i in ids[0] if scores[i] >= quality.GOOD}
    best = {}
    for i in ids[1]:
        key = "".join(text[i].split())
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(text[i]), i))
    assert ids[2] == {i for _, i in best.values()}
    sim = lambda a, b: len(a & b) / len(a | b)
    sh = {i: shingles(text[i]) for i in ids[2]}
    for gone in ids[2] - ids[3]:
        assert max(sim(sh[gone], sh[o]) for o in ids[2] if o != gone) > 0.6
    close = [(a, b) for a in ids[3] for b in ids[3] if a < b and sim(sh[a], sh[b]) >= 0.85]
    assert not close
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {i for i in ids[3] if any(t in text[i] for t in items)} <= ids[3] - ids[4]
    assert len(ids[3] - ids[4]) <= len({i for i in ids[3] if any(t in text[i] for t in items)}) + 1


def test_run_encodes_what_stays(spark):
    got = C.run(spark, SF).collect()
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) > 80
    for r in got:
        ids = lib.encode_ordinary(text[r.doc_id])
        assert (r.ids, r.n_tokens, r.decoded_sha256) == (ids, len(ids), hashlib.sha256(text[r.doc_id].encode()).hexdigest())


def test_odd_tables(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(1, None), (None, "a b"), (2, ""), (3, "x " * 50), (3, "x " * 50), (4, " ".join(f"w{rnd.randrange(99)}" for _ in range(3000)))]
    for name, data in (("full", rows), ("none", [])):
        at = str(tmp_path / name)
        spark.createDataFrame([(i, t, "en", "s", 0, 1.0) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long, score double").write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
        docs = spark.read.parquet(f"{at}/documents.parquet")
        n = [docs.count()]
        for _, f in C.STAGES[1:-1]:
            docs = f(spark, docs, at)
            n.append(docs.count())
        assert n == ([6, 5, 5, 5] if data else [0] * 4)
        assert C.run(spark, at).count() == 0  # without labels every score is 0.5
