"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from whole texts, computed once a document in Arrow batches. The trees are fitted on the driver with numpy from at
most MAX_TRAINING labelled documents (the least hashes of their ids, a documented bound) and flattened into arrays that every
task walks for a whole batch at once. Labels, language, source and id are no inputs.

Edge cases: null and empty texts have all statistics zero and still get a score; rows of labels without an id or a label are
left out; a document with several labels counts with each; rows that repeat a document count once in training, by the least
statistics of them; without any labelled document, or with one class only, the score
is that class's smoothed share; equal texts get equal scores; an empty table gives an empty result. score() reads key and
text alone; keep() passes every column through as it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import least_hashes, map_texts, parts_of, slices, table, texts_of

MAX_TRAINING = 12_000
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.2
MIN_CHILD = 10.0
L2 = 1.0

FEATURES = ("log_bytes", "log_words", "word_bytes", "upper", "digit", "punct", "high", "space", "lines", "line_bytes", "repeated_lines", "distinct_words", "top_word", "adjacent_same", "doubled_punct", "double_bang", "pipe", "sentence_end", "long_words", "short_words", "top_line_words", "upper_lines", "punct_words")

_CLASS = np.full(256, 5, dtype=np.uint8)
_CLASS[128:] = 4
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[48:58] = 2
_CLASS[65:91] = 1
_CLASS[97:123] = 0


def statistics(text: str | None) -> list[float]:
    """The values of FEATURES for one whole text."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    code = np.frombuffer(raw, dtype=np.uint8)
    kind = _CLASS[code]
    n, m = len(raw), len(words)
    count = np.bincount(kind, minlength=6)
    letters = max(1, int(count[0] + count[1] + count[4]))
    punct = kind == 5
    lines = [x for x in raw.split(b"\n") if x]
    size = np.fromiter(map(len, words), dtype=np.int64, count=m)
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    seq = np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=m)
    upper_lines = sum(len(x) for x in lines if x.isupper())
    return [
        np.log1p(n), np.log1p(m), float(size.mean()), count[1] / letters, count[2] / n, count[5] / n, count[4] / n, count[3] / n,
        np.log1p(len(lines)), n / len(lines), 1 - len(set(lines)) / len(lines), len(codes) / m, np.bincount(seq).max() / m, float((seq[1:] == seq[:-1]).mean()) if m > 1 else 0.0,
        float((punct[1:] & (code[1:] == code[:-1])).sum()) / m, raw.count(b"!!") / m, raw.count(b"|") / m, (raw.count(b".") + raw.count(b"?")) / m,
        float((size > 20).mean()), float((size < 3).mean()), max(len(x) for x in lines) / n, upper_lines / n, count[5] / m,
    ]


def matrix(texts: list) -> np.ndarray:
    """Statistics of each text, one row each."""
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Trees:
    """Complete binary trees in arrays [tree, node]: children of node k are 2k+1 and 2k+2; leaves come after the splits."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        splits = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < splits:
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - splits]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost logistic loss over binned features; a node that no split improves passes all its rows to the left."""
    n, k = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    splits = (1 << depth) - 1
    feature = np.zeros((trees, splits), dtype=np.int64)
    threshold = np.full((trees, splits), np.inf)
    value = np.zeros((trees, splits + 1))
    if n == 0 or y.min() == y.max():
        return Trees(base, feature[:0], threshold[:0], value[:0])
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(k)], axis=1)
    score = np.full(n, base)
    offsets = np.arange(k) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            cell = ((node - first)[:, None] * (k * BINS) + offsets + binned).ravel()
            gs = np.bincount(cell, np.repeat(g, k), minlength=width * k * BINS).reshape(width, k, BINS).cumsum(axis=2)
            hs = np.bincount(cell, np.repeat(h, k), minlength=width * k * BINS).reshape(width, k, BINS).cumsum(axis=2)
            ga, ha = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + L2) + (ga - gs) ** 2 / (ha - hs + L2) - ga**2 / (ha + L2)
            gain = np.where((hs >= MIN_CHILD / 10) & (ha - hs >= MIN_CHILD / 10), gain, 0.0)
            for w in range(width):
                j, b = np.unravel_index(int(gain[w].argmax()), gain[w].shape)
                if gain[w, j, b] > 1e-9 and b < len(edges[j]):
                    feature[t, first + w], threshold[t, first + w] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - splits
        gl, hl = np.bincount(leaf, g, minlength=splits + 1), np.bincount(leaf, h, minlength=splits + 1)
        value[t] = -RATE * gl / (hl + L2)
        score += value[t][leaf]
    return Trees(base, feature, threshold, value)


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAINING) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most bound labelled documents that are not held out; ties in the hash go by id."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1)
    picked = usable.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("label"))
    rows = docs.select("doc_id", "text").join(F.broadcast(least_hashes(picked, "label_id", bound)), F.col("doc_id") == F.col("label_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple, list[float]] = {}
        for batch in batches:
            ids, texts, labels = batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2).to_pylist()
            for a, b in slices(texts):
                for k, x in zip(zip(ids[a:b], labels[a:b], strict=True), matrix(texts[a:b]).tolist(), strict=True):
                    least[k] = min(x, least.get(k, x))
        yield pa.record_batch([pa.array([i for i, _ in least], pa.int64()), pa.array([y for _, y in least], pa.int32()), pa.array(list(least.values()), type=pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    once = rows.select("doc_id", "text", "label").mapInArrow(run, "doc_id bigint, label int, x array<double>").groupBy("doc_id", "label").agg(F.min("x").alias("x"))
    got = once.toPandas().sort_values(["doc_id", "label"], kind="stable")
    return np.array(got["x"].tolist(), dtype=float).reshape(len(got), len(FEATURES)), got["label"].to_numpy(dtype=float)


def classifier(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAINING) -> Trees:
    """Trees fitted to the labelled documents."""
    return fit(*training_rows(docs, labels, bound))


def score(docs: DataFrame, trees: Trees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    import zlib

    def work(ids: list, texts: list) -> dict:
        p = trees.predict(matrix(texts))
        return {"doc_id": ids, "held_out": [i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in ids], "score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return map_texts(docs, key, text, "doc_id bigint, held_out boolean, score double, predicted int", work)


def keep(docs: DataFrame, trees: Trees, text: str = "text", at_least: float = 0.5) -> DataFrame:
    """The rows whose score reaches the limit, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, at):
                yield part.filter(pa.array(trees.predict(matrix(texts_of(part.column(at)))) >= at_least))

    return docs.mapInArrow(run, docs.schema)


def op7_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, classifier(docs, table(spark, sf_dir, "labels")))
