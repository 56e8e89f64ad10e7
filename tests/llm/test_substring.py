import hashlib
import random
from collections import Counter

import duckdb

from factweave.llm import queries as Q
from factweave.llm import substring as S


def by_hand(texts, window):
    words = [(t or "").encode().split() for t in texts]
    n = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if n[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append((len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def corpus():
    rnd = random.Random(6)
    new = lambda n: [f"w{rnd.randrange(40)}" for _ in range(n)]
    shared = new(60)
    texts = [None, "", " \n", " ".join(new(34)), "é x " * 20]
    for k in range(60):
        a, b = new(rnd.randrange(60)), new(rnd.randrange(60))
        cut = rnd.choice((33, 34, 35, 36, 60))
        texts.append((" " if k % 2 else "\n\t").join(a + shared[: cut if k % 3 else 0] + b))
    texts += [texts[9], texts[9].replace("\n\t", " "), " ".join(shared), "x " * 35, "y " * 36, "z " * 200, " ".join(new(300) * 2)]
    return texts


def test_against_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(k if k % 9 else None, t, 1) for k, t in enumerate(texts)], "doc_id int, text string, n_words int").repartition(3)
    for window, batches in ((35, 2), (5, 6)):
        want = by_hand(texts, window)
        got = S.repeated(docs, window, batches).collect()
        assert sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted((k if k % 9 else -1, *w) for k, w in enumerate(want))
        assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_index_compacts_and_remembers(spark):
    index = S.FingerprintIndex(spark, fanout=2, buckets=2)
    batch = lambda *f: spark.createDataFrame([(x,) for x in f], "fp long")
    hits = []
    for b in ((1, 2, 2), (3, 1), (4, 4, 5), (5, 9), (9, 1, 6)):
        hits.append(sorted(r.fp for r in index.add(batch(*b)).collect()))
        index.compact()
    assert hits == [[2], [1], [4], [5], [1, 9]] and len(index.runs) == 1
    assert {r.fp: r.n for r in index.rows(index.runs[0]).collect()} == {1: 3, 2: 2, 3: 1, 4: 2, 5: 2, 9: 2, 6: 1}
    index.drop()


def test_same_as_sql(spark, tmp_path):
    spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in Q.op5_substring(spark, str(tmp_path)).collect())
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(c.execute(f"select doc_id, n_words, n_removed, kept_sha256 from ({Q.ORACLES['op5_substring']})").fetchall()) == got


def test_no_rows(spark):
    assert S.repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
