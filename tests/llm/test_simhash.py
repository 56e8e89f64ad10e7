import random

import pytest
import xxhash
from pyspark.sql import functions as F

from factweave.llm import simhash as S
from factweave.llm.components import connected_components


def fp_by_hand(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def comp_by_hand(prints, most):
    ids, root = sorted(prints), {}
    for i in ids:
        root[i] = i
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (prints[i] ^ prints[j]).bit_count() <= most and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def texts():
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(300)] + ["É", "straße", "A", "b" * 90]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.choice((1, 3, 4, 5, 40, 300)))) for _ in range(60)]
    out = [None, "", " \t\n", "one two", "ONE Two", "one  two\tthree four five"]
    for b in base:
        out += [b, b.upper(), b + " tail"]
        w = b.split()
        w[rnd.randrange(len(w))] = "changed"
        out.append("\n".join(w))
    return out


def test_op4_rule_against_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id int, text string, component_id string").repartition(3)
    prints = S.materialise(S.fingerprints(docs), "t")
    got = {r.doc_id: (r.f0 & (1 << 64) - 1, r.component_id) for r in S.near_duplicates(prints).collect()}
    want = {i: fp_by_hand(t) for i, t in rows}
    assert {i: g[0] for i, g in got.items()} == want
    assert {i: g[1] for i, g in got.items()} == comp_by_hand(want, 4)


def test_index_finds_every_pair_within_four_bits(spark):
    assert S.EXACT_4.exact and S.EXACT_4_WIDE.exact and not S.similar_index(10**6).exact
    rnd = random.Random(8)
    prints = {}
    for _ in range(150):
        f = rnd.getrandbits(64)
        for _ in range(3):
            prints[len(prints)] = f
            for b in rnd.sample(range(64), rnd.choice((1, 3, 4, 5))):
                f ^= 1 << b
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in prints.items()], "doc_id long, f0 long")
    for index in (S.EXACT_4, S.EXACT_4_WIDE):
        got = {r.doc_id: r.component_id for r in S.near_duplicates(df, index).collect()}
        assert got == comp_by_hand(prints, 4)


def test_empty_table_null_and_repeated_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(S.fingerprints(none)).count() == 0
    odd = spark.createDataFrame([(None, "a b"), (7, "a b"), (7, "a b"), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id) for r in S.near_duplicates(S.fingerprints(odd)).collect())
    assert got == [(-1, None), (7, 7), (7, 7), (9, 9)]


@pytest.mark.parametrize("n", [2, 50])
def test_components_of_chains(spark, n):
    df = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(100, 100), (None, 3), (201, 200)], "u long, v long").repartition(4)
    for small in (0, 1000):
        got = {r.node: r.component for r in connected_components(df, small=small).collect()}
        assert got == {**{k: 0 for k in range(n + 1)}, 200: 200, 201: 200}


def sets_of(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def kept_by_hand(rows):
    sets = [sets_of(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min(rows[i][0] for i in range(len(rows)) if group[i] == g) for g in group}
    return sorted(r for r, g in zip(rows, group, strict=True) if r[0] == least[g])


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((r.doc_id, r.text) for r in S.keep_one(docs).collect())


def new(rnd, n):
    return [f"w{rnd.randrange(10**6)}" for _ in range(n)]


def test_no_isolated_pair_is_lost(spark):
    """Pairs at 0.8 and just below, from 4 shingles against 5 up to hundreds, that nothing else bridges."""
    rnd, rows = random.Random(4), []
    for n in [8, 8, 8, 9, 13, 14, 40, 104, 304] * 25:
        w = new(rnd, n)
        more = (n - 4) // 4
        rows.append((len(rows), " ".join(w)))
        rows.append((len(rows), " ".join(w + new(rnd, more + rnd.randrange(2)))))
    want = kept_by_hand(rows)
    assert len(rows) / 2 < len(want) < len(rows)
    assert kept(spark, rows) == want


def test_dense_groups_and_common_lines_like_all_pairs(spark):
    rnd, rows = random.Random(7), [(0, ""), (1, "a b"), (2, "A  b"), (3, "x " * 50)]
    line = new(rnd, 12)
    for _ in range(6):
        base = new(rnd, 60)
        for _ in range(25):
            w = base[:]
            for at in rnd.sample(range(60), rnd.randrange(5)):
                w[at] = new(rnd, 1)[0]
            rows.append((len(rows), " ".join(w + line * rnd.randrange(3))))
    assert kept(spark, rows) == kept_by_hand(rows)


def test_repeats_count_once(spark):
    rnd = random.Random(11)
    body, line = new(rnd, 300), new(rnd, 12)
    rows = [(1, " ".join(body + line)), (2, " ".join(body + line * 5))]  # similarity above 0.9
    rows += [(k, " ".join(new(rnd, 300) + line * 20)) for k in (3, 4)]  # below 0.1
    assert kept(spark, rows) == [rows[0], *rows[2:]] == kept_by_hand(rows)


def test_repeated_ids_with_different_texts(spark):
    rnd = random.Random(12)
    a, b, c = (" ".join(new(rnd, 40)) for _ in range(3))
    assert kept(spark, [(3, a), (7, a + " tail"), (7, b), (9, b + " end"), (9, c), (9, c)]) == sorted([(3, a), (7, b), (9, c), (9, c)])
    assert kept(spark, [(5, a), (5, a + " tail"), (5, b)]) in ([(5, x), (5, b)] if x < b else [(5, b), (5, x)] for x in (a, a + " tail"))


def test_filed_rows_are_moved_once_for_both_sides_of_a_join(spark, monkeypatch):
    index = S.similar_index(100)
    words = [f"f{k}" for k in range(index.lanes)]
    prints = spark.range(100).select(F.col("id").alias("node"), F.lit(100).cast("long").alias("size"), F.array(-1 - F.col("id")).alias("short"), *(F.xxhash64(F.floor(F.col("id") / 2), F.lit(w)).alias(w) for w in words))
    nodes = S.materialise(prints, "nodes").withColumn("long", F.col("size") > S.SHORT)
    plans, write = [], S.materialise

    def seen(df, label):
        if label == "neighbours":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return write(df, label)

    monkeypatch.setattr(S, "materialise", seen)
    monkeypatch.setattr(S, "ROUNDS", 0)
    S.links(nodes, index, lambda _: None, ("size", *words), lambda u, v: F.col(f"{u}size") <= F.col(f"{v}size") + 1)
    assert len(plans) >= 2 and all("ReusedExchange" in p and "key#" in p.split("ReusedExchange")[1].split("]")[0] for p in plans[:2])
