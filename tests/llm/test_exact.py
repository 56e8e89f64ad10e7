import hashlib
import random
from collections import Counter

from factweave.llm import exact as E


def by_hand(rows):
    norm = [(i, hashlib.sha256(b"".join((t or "").encode().split())).hexdigest(), len(t or "")) for i, t in rows]
    out = []
    for i, h, _ in norm:
        group = [x for x in norm if x[1] == h]
        best = min(group, key=lambda x: (-x[2], x[0]))
        out.append((i, best[0], len(group), i == best[0], h))
    return sorted(out)


def test_against_brute_force(spark):
    rnd = random.Random(0)
    rows = [(k, rnd.choice([None, "", " ", "a b", "ab", "a\tb ", "a b", "É", "é", "x y z", "hot"] + ["hot"] * 20 + [f"own {k}"])) for k in range(400)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id int, text string, digest string").repartition(4)
    for counters in (2, 8, E.COUNTERS):
        got = E.resolve(E.materialise(E.digests(docs), "t"), counters)
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in got.collect()) == by_hand(rows)
    assert sorted(r.doc_id for r in E.keep_one(docs).collect()) == sorted(r[0] for r in by_hand(rows) if r[3])


def test_null_and_repeated_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (4, "a"), (4, "a"), (None, "b")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in E.resolve(E.materialise(E.digests(docs), "t")).collect())
    assert got == [(-1, -1, 1, True), (-1, 4, 3, False), (4, 4, 3, True), (4, 4, 3, True)]
    none = docs.limit(0)
    assert E.resolve(E.materialise(E.digests(none), "t")).count() == 0 and E.keep_one(none).count() == 0


def test_misra_gries_bound():
    rnd = random.Random(1)
    data = [rnd.choice("aaabbc" + "".join(map(chr, range(200, 300)))) for _ in range(5000)]
    true, low = Counter(data), Counter()
    for k in range(0, 5000, 50):
        low.update(data[k : k + 50])
        low = E.shrink(low, 9)
    assert len(low) <= 9 and all(true[x] - 5000 / 10 <= low[x] <= true[x] for x in true)


def test_only_the_copies_go(spark):
    docs = spark.createDataFrame([(None, "a"), (4, "a"), (4, "a"), (None, "b"), (None, None), (5, "é \x0bé"), (6, "é\t\r\n\x0cé"), (6, "e\t\r\n\x0ce"), (5, "xyé")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.text or "") for r in E.keep_one(docs).collect())
    assert got == [(-1, ""), (-1, "b"), (4, "a"), (4, "a"), (5, "xyé"), (6, "e\t\r\n\x0ce"), (6, "é\t\r\n\x0cé")]
