"""License scans: an Aho-Corasick automaton finds notice phrases and identifier tags, a shunting-yard parser reads expressions.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z is lower-cased: ASCII letters and digits, and all that isn't ASCII.
The automaton runs over the words joined by single spaces, so a phrase is found whatever stands between its words, and
overlapping finds all count. A tag's expression is read from the text itself: identifiers, AND, OR, WITH and brackets, up to
the first thing that is none of these. WITH binds closest, then AND, then OR. An expression that breaks off or has
unbalanced brackets gives no labels, only the flag spdx_bad.

score: 0 without any label, else 1 - 0.5 ** places, where a tag counts as three places.

Defined cases: null is the empty text (no words, no labels); repeated rows are scanned row by row; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, only

#: Phrases whose places are counted. Fixed values.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notice phrases of well-known licences and their labels. Fixed values.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl-1",
    "the unlicense": "unlicense",
    "creative commons zero": "cc0",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
}
#: SPDX identifiers whose label is another's; all other identifiers are their own label, lower-cased. Fixed values.
SPDX_LABELS = {"apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "gpl-2.0-only": "gpl-2", "gpl-2.0-or-later": "gpl-2", "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3", "cc0-1.0": "cc0"}
#: Labels under which text may be used, for the verdict on an expression.
PERMISSIVE = frozenset(("mit", "apache-2", "bsd", "bsd-2-clause", "bsd-3-clause", "isc", "cc0", "unlicense", "zlib", "bsl-1"))
TAG = "spdx license identifier"
TAG_IN_TEXT = re.compile(rb"spdx-license-identifier:[ \t]*", re.I)
TOKEN = re.compile(rb"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+-]*))")
RANK = {"or": 1, "and": 2, "with": 3}

_WORD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def label_of(identifier: str) -> str:
    low = identifier.lower()
    return SPDX_LABELS.get(low, low)


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting yard. None if the expression isn't well formed."""
    out: list[str] = []
    held: list[str] = []
    want_name = True
    for t in tokens:
        low = t.lower()
        if t == "(":
            if not want_name:
                return None
            held.append(t)
        elif t == ")":
            if want_name:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif low in RANK:
            if want_name:
                return None
            while held and held[-1] != "(" and RANK[held[-1]] >= RANK[low]:
                out.append(held.pop())
            held.append(low)
            want_name = True
        else:
            if not want_name:
                return None
            out.append(t)
            want_name = False
    if want_name or "(" in held:
        return None
    return out + held[::-1]


def evaluate(postfix: list[str], allowed: frozenset[str] = PERMISSIVE) -> tuple[set[str], bool]:
    """(labels named, whether the text may be used under `allowed`). AND needs both sides, OR one; an exception given by
    WITH widens what its licence grants, so the licence alone decides."""
    stack: list[tuple[set[str], bool]] = []
    for t in postfix:
        if t in RANK:
            b, a = stack.pop(), stack.pop()
            stack.append(a if t == "with" else (a[0] | b[0], a[1] and b[1] if t == "and" else a[1] or b[1]))
        else:
            label = label_of(t)
            stack.append(({label}, label in allowed))
    return stack[0]


def expression_at(raw: bytes, at: int) -> list[str]:
    tokens, depth = [], 0
    while m := TOKEN.match(raw, at):
        token = (m[1] or m[2]).decode()
        named = tokens and tokens[-1].lower() not in RANK and tokens[-1] != "("
        if named and token != ")" and token.lower() not in RANK or token == ")" and not depth:
            break  # prose or a comment's end follows
        depth += (token == "(") - (token == ")")
        tokens.append(token)
        at = m.end()
    return tokens


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, label in BASE.items():
        found.add_word(f" {phrase} ", (len(phrase), label, True))
    for phrase, label in NOTICES.items():
        found.add_word(f" {phrase} ", (len(phrase), label, False))
    found.add_word(f" {TAG} ", (len(TAG), "", False))
    found.make_automaton()
    return found


def scan(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spdx_usable, spdx_bad"""
    raw = (text or "").encode()
    words = raw.translate(_WORD).split()
    joined = b" " + b" ".join(words) + b" "
    places, base, labels, n = [], set(), set(), 0
    tagged = False
    for end, (size, label, is_base) in automaton().iter(joined.decode("latin-1")):  # a byte is a character
        if not label:
            tagged = True
            continue
        n += 1
        labels.add(label)
        if is_base:
            base.add(label)
            places.append(joined.count(b" ", 0, end - size - 1))
    usable, bad = None, False
    if tagged:
        for m in TAG_IN_TEXT.finditer(raw):
            postfix = to_postfix(expression_at(raw, m.end()))
            if postfix is None:
                bad = True
                continue
            got, fine = evaluate(postfix)
            labels |= got
            usable = fine if usable is None else usable and fine
            n += 3
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1 - 0.5**n, usable, bad


NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spdx_usable", "spdx_bad")


def _work() -> Callable[[pa.RecordBatch], dict]:
    def one(batch: pa.RecordBatch) -> dict:
        rows = [scan(value.as_py()) for value in batch.column("text")]
        return {"doc_id": batch.column("doc_id")} | dict(zip(NAMES, zip(*rows, strict=True), strict=True))

    return one


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the columns of NAMES, for every row."""
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return map_batches(slim, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spdx_usable boolean, spdx_bad boolean", _work)
