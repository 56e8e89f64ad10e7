import random

import numpy as np

from factweave.llm import decontam as D


def edit_infix(item, text):
    """Least edit distance of item to any stretch of text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def words_of(text):
    return D.plain(text).split()


def vary(rnd, words, edits):
    words = words[:]
    for _ in range(edits):
        k = rnd.randrange(len(words))
        kind = rnd.randrange(3)
        if kind == 0:
            words[k] = f"new{rnd.randrange(99)}"
        elif kind == 1:
            words.insert(k, f"ins{rnd.randrange(99)}")
        elif len(words) > 2:
            del words[k]
    return words


def fixture():
    rnd = random.Random(9)
    vocabulary = [f"w{k}" for k in range(400)] + ["the", "of", "and"] * 60
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(n))) for k, n in enumerate([5, 8, 15, 20, 27, 31, 40, 57] * 4)]
    docs = []
    for k in range(400):
        body = [rnd.choice(vocabulary) for _ in range(rnd.randrange(80))]
        if k % 2:
            words = items[rnd.randrange(len(items))][1].split()
            words = vary(rnd, words, rnd.randrange(int(len(words) * 0.3) + 1))
            at = rnd.randrange(len(body) + 1)
            body[at:at] = [w.upper() + rnd.choice(["", ",", "."]) for w in words]
        docs.append((k, " ".join(body)))
    return items, docs


def test_distance_like_cell_by_cell():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(1, 9))] for _ in range(2))
        cost, start, end = D.distance(np.array(a), np.array(b))
        assert cost == edit_infix(a, b)
        full = [list(range(end - start + 1))]
        for i, x in enumerate(a, 1):
            full.append([i])
            for j, y in enumerate(b[start:end], 1):
                full[-1].append(min(full[-2][j] + 1, full[-1][j - 1] + 1, full[-2][j - 1] + (x != y)))
        assert full[-1][-1] == cost


def test_against_brute_force(spark):
    items, docs = fixture()
    want = {}
    for i, t in items:
        w = words_of(t)
        for d, text in docs:
            cost = edit_infix(w, words_of(text))
            if cost <= int(0.2 * len(w) + 1e-9):
                want[d, i] = cost
    got = {(r.doc_id, r.item_id): r.distance for r in D.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) <= set(want) and len(want) > 100
    assert len(got) >= 0.99 * len(want)
    assert np.mean([got[k] == want[k] for k in got]) > 0.98


def test_unchanged_passages_are_always_found(spark):
    items, _ = fixture()
    docs = [(i, f"before it {t} after") for i, t in items]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.n_words, r.distance) for r in D.leaks(*frames).collect()}
    assert all(got[i, i] == (2, len(t.split()), 0) for i, t in items)
    assert D.keep_clean(*frames).count() == 0


def test_blocks_and_odd_rows(spark):
    items = [(1, "one two three four five six"), (None, "seven eight nine ten eleven twelve"), (3, None), (4, ""), (5, "too short"), (1, "one two three four five six")]
    docs = spark.createDataFrame([(1, None, "k"), (None, "x ONE, two three four FIVE six!", "k"), (2, "seven eight nine ten eleven", "k"), (2, "too short", "k"), (3, "", "k")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [(-1, 1), (-1, 1), (2, -1), (2, 5)]
    assert sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.item_id is None else r.item_id) for r in D.leaks(docs, bench).collect()) == want
    assert sum(len(b.ids) for b in D.blocks(bench, most=7)) == 4 and len(list(D.blocks(bench, most=7))) == 4
    assert sorted(r.text or "" for r in D.keep_clean(docs, bench).collect()) == ["", ""]
    assert D.keep_clean(docs, bench).columns == docs.columns
    assert D.leaks(docs, bench.limit(0)).count() == 0 and D.keep_clean(docs, bench.limit(0)).count() == 5 and D.leaks(docs.limit(0), bench).count() == 0


def test_every_leak_at_exactly_the_threshold_is_found():
    """floor(0.2 n) edits spread evenly, from 30 to 400 words: a replaced word, or words put in and left out."""
    rnd = random.Random(21)
    hashes = lambda words: D.xxh64_spans((w := D.Words([" ".join(words).encode()])).raw, w.starts, w.ends)
    for n in (30, 57, 100, 200, 400):
        items = [(k, [f"w{rnd.randrange(3000)}" for _ in range(n)]) for k in range(6)]
        block = D.Items.of([(k, " ".join(w)) for k, w in items])
        d = int(0.2 * n + 1e-9)
        for k, words in items:
            for shape in range(3):
                text = words[:]
                for j in reversed(range(d)):
                    at = j * n // d + rnd.randrange(n // d)
                    if shape == 0 or (shape == 2 and j % 3 == 0):
                        text[at] = f"new{j}"
                    elif j % 2:
                        text.insert(at, f"new{j}")
                    else:
                        del text[at]
                around = [[f"w{rnd.randrange(3000)}" for _ in range(50)] for _ in range(2)]
                got = block.search(hashes(around[0] + text + around[1]))
                assert set(got) == {k} and got[k][0] <= d
                assert edit_infix(words, around[0] + text + around[1]) == got[k][0]


def test_short_items_are_searched_word_for_word(spark):
    docs = spark.createDataFrame([(1, "x Forty-two y"), (2, "forty x two"), (3, "a b c d e"), (4, "a b x d e"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(10, "forty two"), (11, "B c, d"), (12, ""), (13, "q")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in D.leaks(docs, items).collect()) == [(1, 10), (3, 11)]
    assert sorted(r.doc_id for r in D.keep_clean(docs, items).collect()) == [2, 4, 5]
    assert D.leaks(docs, items, least=3).select("item_id").collect() == [(11,)]
