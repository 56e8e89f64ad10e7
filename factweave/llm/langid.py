"""Language ID by error-correcting output codes.

Every language has a codeword. For each of its bits a binary classifier (naive Bayes over hashed runs of one to three
characters, lower-cased, every stretch without letters one space) tells the languages with a 1 from those with a 0. A text's
margin for a bit is the mean log-odds of its runs, times the number of runs up to EVIDENCE, for neighbouring runs aren't
independent. Decoding is loss-weighted: a codeword's loss is the sum over bits of log(1 + exp(-sign * margin)), each weighted
by the log-odds of that bit's being right on the training sample; the nearest codeword wins. The score is its share of
exp(-loss), and `ambiguous` says that the runner-up is within CLOSE.

With up to six languages the code is exhaustive (every way to split them, 2 ** (k - 1) - 1 bits); with more it is the best
of some random codes by least distance between codewords.

At most PER_LANGUAGE rows of a language train, about, chosen by a hash of their id. They are whole texts, counted on the
executors; the driver gets a fixed number of count tables. Only the text enters a prediction.

Defined cases: null text or text without letters: `und`, score 0, not ambiguous; no labelled rows: likewise for all; one
language: always that one, score 1; ties go to the language that sorts first; no rows give no rows.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, only

PER_LANGUAGE, SLOTS, EVIDENCE, CLOSE, SMOOTH = 800, 1 << 14, 60, 1.0, 0.5
#: Tasks that count the training sample.
COUNTING_TASKS = 8
#: Characters taken at once, which bounds a task's arrays for very long texts.
BLOCK = 2_000_000


@cache
def _letters() -> np.ndarray:
    """For each code point: whether it is a letter."""
    out = np.zeros(sys.maxunicode + 1, bool)
    for k in range(sys.maxunicode + 1):
        out[k] = unicodedata.category(chr(k))[0] == "L"
    return out


def counts(text: str) -> np.ndarray | None:
    """How often each slot's runs occur in the whole text; None without letters."""
    total, tail, any_letter = np.zeros(SLOTS, np.int64), np.array([32], np.uint32), False
    for k in range(0, len(text), BLOCK):
        points = np.frombuffer(text[k : k + BLOCK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        any_letter |= bool(letter.any())
        a = np.concatenate([tail, np.where(letter, points, 32).astype(np.uint32)])
        a = a[np.concatenate([[True], (a[1:] != 32) | (a[:-1] != 32)])]
        for n, p in enumerate((0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)):
            first = max(0, len(tail) - n)  # runs that end in the tail were counted with the block before
            h = np.full(max(0, len(a) - n - first), p, np.uint32)
            for j in range(n + 1):
                h = (h ^ a[first + j : first + j + len(h)]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            total += np.bincount((h * np.uint32(p) >> np.uint32(13)) & np.uint32(SLOTS - 1), minlength=SLOTS)
        tail = a[-2:]
    return total if any_letter else None


def codewords(k: int) -> np.ndarray:
    """Rows of 0 and 1, one for each language."""
    if k <= 6:
        return np.array([[0 if not row else (bit + 1) >> (row - 1) & 1 for bit in range(2 ** (k - 1) - 1)] for row in range(k)]).reshape(k, -1)
    rnd, best, found = np.random.default_rng(20), None, -1
    bits = max(15, int(np.ceil(10 * np.log2(k))))
    for _ in range(200):
        code = rnd.integers(0, 2, (k, bits))
        apart = (code[:, None] != code[None]).sum(axis=2) + bits * np.eye(k, dtype=int)
        split = code.any(axis=0).all() and not code.all(axis=0).any()
        if split and apart.min() > found:
            best, found = code, apart.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # slots x bits
    trust: np.ndarray  # of each bit

    def margins(self, c: np.ndarray) -> np.ndarray:
        n = max(1, int(c.sum()))
        return (c.astype(np.float32) @ self.weights) * (min(n, EVIDENCE) / n)

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (np.logaddexp(0, -(2 * self.code - 1) * margins) * self.trust).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        share = np.exp(loss[order[0]] - loss)
        return self.languages[order[0]], float(1 / share.sum()), bool(loss[order[1]] - loss[order[0]] < CLOSE)


def build(tables: dict[str, np.ndarray]) -> Model:
    """tables: the counts of each language. Bits are trusted alike until measured."""
    names = sorted(tables)
    code = codewords(len(names))
    by = np.stack([tables[n] for n in names]).astype(float)
    freq = (by + SMOOTH) / (by + SMOOTH).sum(axis=1, keepdims=True)  # every language counts alike
    weights = np.zeros((SLOTS, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        on = code[:, b] == 1
        weights[:, b] = np.log(freq[on].mean(axis=0)) - np.log(freq[~on].mean(axis=0))
    return Model(names, code, weights, np.ones(code.shape[1]))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            if (c := counts(text.as_py() or "")) is not None:
                sums[lang] = sums[lang] + c if lang in sums else c
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["lang", "table"])


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """labelled: (doc_id, lang, text) of the rows that may train."""
    rows = labelled.where("lang is not null")
    have = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not have:
        return None
    share = F.create_map(*(F.lit(x) for lang, n in sorted(have.items()) for x in (lang, min(1.0, per_language / n))))
    chosen = rows.where("text is not null").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    sample = materialise(chosen.select("doc_id", "lang", "text").repartition(COUNTING_TASKS, "doc_id"), "langid-sample").coalesce(COUNTING_TASKS)
    tables: dict[str, np.ndarray] = {}
    for r in sample.mapInArrow(_tables, "lang string, table binary").collect():
        one = np.frombuffer(r["table"], np.int64)
        tables[r["lang"]] = tables[r["lang"]] + one if r["lang"] in tables else one
    if not tables:
        return None
    model = build(tables)
    if len(model.languages) > 1:
        shared = sample.sparkSession.sparkContext.broadcast(model)

        def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            n, good = 0, np.zeros(m.code.shape[1], np.int64)
            for batch in batches:
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                    if (c := counts(text.as_py() or "")) is not None:
                        n += 1
                        good += (m.margins(c) > 0) == (m.code[m.languages.index(lang)] == 1)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([good.tobytes()], pa.binary())], names=["n", "good"])

        parts = sample.mapInArrow(right, "n long, good binary").collect()
        n, good = sum(r["n"] for r in parts), sum(np.frombuffer(r["good"], np.int64) for r in parts)
        ok = (good + 1) / (n + 2)
        model.trust = np.maximum(0.05, np.log(ok / (1 - ok))) / np.log(n + 2)
    return model


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every row of docs."""
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work() -> Callable[[pa.RecordBatch], dict]:
        m = shared.value

        def one(batch: pa.RecordBatch) -> dict:
            rows = []
            for text in batch.column("text"):
                c = counts(text.as_py() or "") if m is not None else None
                rows.append(("und", 0.0, False) if c is None else m.decode(m.margins(c)))
            lang, score, ambiguous = zip(*rows, strict=True)
            return {"doc_id": batch.column("doc_id"), "lang_pred": lang, "score": score, "ambiguous": ambiguous}

        return one

    return map_batches(slim, "doc_id long, lang_pred string, score double, ambiguous boolean", work)
