"""Quality classifier: histogram gradient-boosted trees over document statistics.

Each whole text becomes the statistics named in STATISTICS (one pass, on the executors). At most FIT_ROWS labelled rows,
chosen by a hash of their id, train the trees on the driver: statistics are binned at their quantiles, every level's
histograms of gradients and curvatures give the best split of each node, and leaves take a Newton step. The trees are then
laid end to end in flat arrays, and all documents of a batch walk all trees together, one numpy step for each level.

Only the text enters a score. Defined cases: null counts as the empty text, which is scored like any other; without labels
of both classes every score is the mean label (0.5 if there are none); repeated ids are scored row by row; a document with
several labels trains with each; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, only, parted, shares, trim

#: Labelled rows that train, at most; score from which a document counts as good.
FIT_ROWS, GOOD = 12_000, 0.7
TREES, DEPTH, BINS, RATE, LEAST_ROWS, L2 = 60, 4, 64, 0.15, 15, 1.0

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper", "digits", "punctuation", "odd_symbols", "bars", "exclamations", "not_ascii", "entropy",
    "distinct_words", "distinct_words_of_root", "top_word", "same_as_before", "single_character_words", "long_words", "ends_in_punctuation", "only_symbols", "capital_words",
    "log_lines", "words_in_line", "distinct_lines", "distinct_runs",
)

_KIND = np.zeros((256, 6))
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = [_b < 128 and _c.isupper(), 48 <= _b < 58, _c in ".,;:?'\"()-", _c in "#$%&*+/<=>@[\\]^_`{}~", _c == "|", _c == "!"]


def statistics(raw: bytes) -> list[float]:
    n = len(raw)
    words = raw.split()
    k = len(words)
    if not k:
        return [np.log1p(n)] + [0.0] * (len(STATISTICS) - 1)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    kinds = hist @ _KIND
    share = hist[hist > 0] / n
    size = np.fromiter(map(len, words), np.int64, k)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    ids = np.fromiter(map(hash, words), np.int64, k).view(np.uint64)
    runs = ids[:-2] * np.uint64(3) + ids[1:-1] * np.uint64(5) + ids[2:] if k > 2 else ids
    last = np.fromiter((w[-1] for w in words), np.uint8, k)
    first = np.fromiter((w[0] for w in words), np.uint8, k)
    plain = last[(last < 128)]
    return [
        np.log1p(n), np.log1p(k), size.mean(), size.std(), kinds[0] / n, kinds[1] / n, kinds[2] / n, kinds[3] / n, kinds[4] / n, kinds[5] / n, hist[128:].sum() / n, float(-(share * np.log2(share)).sum()),
        len(seen) / k, len(seen) / np.sqrt(k), max(seen.values()) / k, float((ids[1:] == ids[:-1]).mean()) if k > 1 else 0.0, float((size == 1).mean()), float((size > 20).mean()), float(np.isin(plain, _PUNCTUATION).sum()) / k,
        sum(not w.isalnum() and len(w) < 4 and w.isascii() and not any(c > 47 for c in w) for w in seen) / len(seen), float(((first > 64) & (first < 91)).mean()),
        np.log1p(len(lines)), k / max(1, len(lines)), len(set(lines)) / max(1, len(lines)), len(np.unique(runs)) / len(runs),
    ]


_PUNCTUATION = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)


def _measure() -> Callable[[pa.RecordBatch], dict]:
    def one(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "x": [np.array(statistics((t.as_py() or "").encode()), np.float32) for t in batch.column("text")]}

    return one


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, x (the statistics, array<float>)."""
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return map_batches(slim, "doc_id long, x array<float>", _measure)


@dataclass
class Forest:
    """Trees end to end. A leaf's children are itself; node i goes left if x[feature[i]] <= cut[i]."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of x."""
        total = np.full(len(x), self.base)
        if len(self.roots):
            for at in range(0, len(x), 4096):
                part = x[at : at + 4096]
                node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
                rows = np.arange(len(part))[:, None]
                for _ in range(self.depth):
                    node = np.where(part[rows, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
                total[at : at + 4096] += self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Trees for the labels y (0 or 1) of rows x."""
    empty = np.zeros(0, np.int64)
    p = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < p < 1:
        return Forest(empty, empty, empty, empty, empty, empty, 40.0 * (p > 0.5) - 40.0 * (p < 0.5), 0)
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1], method="lower")) for j in range(d)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(d)], axis=1)
    flat = binned + np.arange(d) * BINS
    base = float(np.log(p / (1 - p)))
    margin = np.full(n, base)
    roots, feature, cut, left, right, value = [], [], [], [], [], []

    def node() -> int:
        k = len(value)
        feature.append(0), cut.append(np.inf), left.append(k), right.append(k), value.append(0.0)
        return k

    for _ in range(TREES):
        prob = 1 / (1 + np.exp(-margin))
        grad, curve = prob - y, prob * (1 - prob)
        roots.append(node())
        level, where = [roots[-1]], np.zeros(n, np.int64)  # where: place in level, or -1 in a finished leaf
        for _ in range(DEPTH):
            live = np.flatnonzero(where >= 0)
            if not len(live):
                break
            key = (where[live, None] * (d * BINS) + flat[live]).ravel()
            room = len(level) * d * BINS
            g, h, c = (np.bincount(key, w, room).reshape(len(level), d, BINS) for w in (np.repeat(grad[live], d), np.repeat(curve[live], d), None))
            gl, hl, cl = (np.cumsum(v, axis=2) for v in (g, h, c))
            gt, ht, ct = gl[:, :, -1:], hl[:, :, -1:], cl[:, :, -1:]
            gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain[(cl < LEAST_ROWS) | (ct - cl < LEAST_ROWS)] = -1
            best = gain.reshape(len(level), -1).argmax(axis=1)
            following, go = [], np.full((len(level), 3), -1)
            for k, parent in enumerate(level):
                j, b = divmod(int(best[k]), BINS)
                if gain[k, j, b] <= 1e-6 or b >= len(cuts[j]):
                    continue
                feature[parent], cut[parent] = j, float(cuts[j][b])
                left[parent], right[parent] = node(), node()
                go[k] = j, b, len(following)
                following += [left[parent], right[parent]]
            j, b, k = go[where[live]].T
            where[live] = np.where(j < 0, -1, k + (binned[live, np.maximum(j, 0)] > b))
            level = following
        tree = Forest(np.array(roots[-1:]), *(np.array(v) for v in (feature, cut, left, right)), np.zeros(len(value)), 0.0, DEPTH)
        at = np.full(n, roots[-1])
        for _ in range(DEPTH):
            at = np.where(x[np.arange(n), tree.feature[at]] <= tree.cut[at], tree.left[at], tree.right[at])
        g, h = np.bincount(at, grad, len(value)), np.bincount(at, curve, len(value))
        step = -RATE * g / (h + L2)
        for k in np.unique(at).tolist():
            value[k] = float(step[k])
        margin += step[at]
    return Forest(*(np.array(v) for v in (roots, feature, cut, left, right, value)), base, DEPTH)


def train(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Forest:
    """labels: (doc_id, label) of the rows that may train. Only labelled documents that the hash of their id chooses are
    measured (and those that share a slot with one), and at most `most` rows of statistics reach the driver."""
    wanted = labels.where("label is not null").select(F.col("doc_id").cast("long").alias("of"), F.col("label").cast("double").alias("label"))
    share = int(1_000_000 * min(1.0, 1.1 * most / max(1, wanted.count()))) + 1
    chosen = materialise(wanted.where(F.pmod(F.xxhash64("of"), F.lit(1_000_000)) < share), "chosen")
    features = materialise(measured(parted(docs, chosen.select("of"), id_col)[0], id_col, text_col), "statistics")
    known = features.join(chosen, F.col("doc_id") == F.col("of")).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)))
    rows = known.orderBy("part", "doc_id", "label").limit(most).select("x", "label").toPandas()
    x = np.stack(rows["x"].to_list()).astype(np.float32) if len(rows) else np.zeros((0, len(STATISTICS)), np.float32)
    return fit(x, rows["label"].to_numpy(float))


def _score(forest: Forest, batch: pa.RecordBatch, at: int) -> np.ndarray:
    x = np.array([statistics((t.as_py() or "").encode()) for t in batch.column(at)], np.float32)
    return forest.score(x.reshape(batch.num_rows, len(STATISTICS)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score for every row of docs; labels: (doc_id, label) of the rows that may train."""
    forest = train(docs, labels, id_col=id_col, text_col=text_col)
    slim = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return map_batches(slim, "doc_id long, score double", lambda: lambda batch: {"doc_id": batch.column("doc_id"), "score": _score(forest, batch, 1)})


def keep_good(docs: DataFrame, labels: DataFrame, least: float = GOOD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that score at least `least`, judged where they lie."""
    forest = train(docs, labels, id_col=id_col, text_col=text_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in shares(whole):
                yield batch.filter(pa.array(_score(forest, batch, at) >= least))
            trim()

    return docs.mapInArrow(run, docs.schema)
