import re

from factweave.llm import licenses as L

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base_by_hand(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, places, labels = WORD.findall(low), [], set()
    for phrase, label in L.BASE.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    None,
    "",
    "Released under the MIT License.",
    "under the mit licenses; under_the-MIT\nlicense under the mit license",
    "Apache License, Version 2.0, apache license version 2 CC BY-NC 4.0",
    "éunder the mit license — CC.BY/NC",
    "cc by nc cc by nc",
    "x" * 500 + " under the mit license " * 50,
    "ſ under the mit ſlicense K",
]


def test_base_against_brute_force():
    for t in TEXTS:
        assert L.scan(t)[:5] == base_by_hand(t)


def test_expressions():
    ev = lambda s: L.evaluate(L.to_postfix(s.replace("(", "( ").replace(")", " )").split()))
    assert L.to_postfix("MIT OR Apache-2.0 AND X WITH e".split()) == ["MIT", "Apache-2.0", "X", "e", "with", "and", "or"]
    assert ev("MIT OR GPL-3.0-only") == ({"mit", "gpl-3"}, True)
    assert ev("MIT AND GPL-3.0-only") == ({"mit", "gpl-3"}, False)
    assert ev("(MIT OR X) AND (ISC OR Y)")[1] and not ev("MIT OR X AND Y WITH e AND (Z)")[0] - {"mit", "x", "y", "z"}
    for bad in ("", "MIT OR", "OR MIT", "( MIT", "MIT )", "MIT ISC", "( )"):
        assert L.to_postfix(bad.split()) is None


def test_tags():
    assert L.scan("// SPDX-License-Identifier: MIT OR GPL-3.0-only\ncode")[5:9] == ("gpl-3,mit", 0.875, True, False)
    assert L.scan("/* spdx-license-identifier: (Apache-2.0) */ prose follows")[5] == "apache-2"
    assert L.scan("SPDX-License-Identifier: MIT and then")[5:9] == ("mit,then", 0.875, False, False)
    assert L.scan("SPDX-License-Identifier: (MIT")[5:9] == ("", 0.0, None, True)
    assert L.scan("This is the GNU General Public License, version 3.")[5] == "gpl-3"


def test_dataframe(spark):
    docs = spark.createDataFrame([(k, t, "z") for k, t in enumerate(TEXTS)] + [(None, "a", "z")], "doc_id long, text string, labels string")
    got = {r.doc_id: tuple(r)[1:6] for r in L.licenses(docs).collect()}
    assert got == {**{k: base_by_hand(t) for k, t in enumerate(TEXTS)}, None: (1, 0, None, None, "")}
    assert L.licenses(docs.limit(0)).count() == 0
