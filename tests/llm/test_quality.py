import numpy as np

from factweave.llm import quality as Q
from factweave.llm import queries

SF = "/root/testdata/sf0.1"


def test_trees_fit_what_lines_cannot():
    rnd = np.random.default_rng(1)
    x = rnd.random((4000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    forest = Q.fit(x[:3000], y[:3000])
    assert ((forest.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97


def test_flat_traversal_like_walking_each_tree():
    rnd = np.random.default_rng(2)
    x = rnd.random((500, 4)).astype(np.float32)
    f = Q.fit(x, (x[:, 2] + rnd.random(500) > 1).astype(float))
    def walk(row):
        total = f.base
        for at in f.roots:
            for _ in range(f.depth):
                at = f.left[at] if row[f.feature[at]] <= f.cut[at] else f.right[at]
            total += f.value[at]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(f.score(x), [walk(r) for r in x])


def test_one_class_and_none():
    x = np.zeros((3, 2), np.float32)
    assert Q.fit(x, np.ones(3)).score(x).tolist() == [1.0] * 3
    assert Q.fit(x, np.zeros(3)).score(x).max() < 1e-9
    assert Q.fit(x[:0], np.zeros(0)).score(x).tolist() == [0.5] * 3
    assert set(Q.fit(x, np.array([0, 1, 1.0])).score(x).round(3)) == {0.667}


def test_statistics_are_finite():
    for raw in (b"", b" \n", b"a", b"a a", "é".encode(), b"!" * 5000, b"x\n" * 100):
        s = Q.statistics(raw)
        assert len(s) == len(Q.STATISTICS) and np.isfinite(s).all()


def test_held_out_accuracy(spark):
    got = queries.op10_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.predicted == 1).mean() > 0.98 and (bad.predicted == 0).mean() > 0.85


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (None, "a b", 3), (2, "x", 3), (2, "x", 3)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (9, 1)], "doc_id long, label int")
    assert sorted((r.doc_id or -1) for r in Q.classify(docs, labels).collect()) == [-1, 1, 2, 2]
    kept = Q.keep_good(docs, labels, 0.0)
    assert kept.columns == docs.columns and kept.count() == 4
    assert Q.keep_good(docs, labels, 1.1).count() == 0 and Q.classify(docs.limit(0), labels).count() == 0
    assert {r.score for r in Q.classify(docs, labels.limit(0)).collect()} == {0.5}
