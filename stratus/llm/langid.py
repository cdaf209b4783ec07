"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

A text becomes the relative frequencies of its hashed one- to three-grams of lower-cased letters (other characters count as one
space), times the inverse document frequency, counted over all documents that may be learned from. Weights are learned by follow-the-regularised-leader with
elastic-net penalties, which leaves most of them zero, and the scores are then calibrated by one temperature on documents
kept aside from the training. Fitting takes at most MAX_TRAINING documents (a documented bound, shared evenly between the languages:
of each those of the least hashes of their ids); prediction covers every whole text, in windows that carry the last two characters
on, so that memory stays bounded and the counts are those of the text in one piece.

Edge cases: a null text or one without a letter is `und` with score 0; documents without a language or an id are not learned
from, and rows that repeat a document in a language are learned from once, by the least of their counts; with no training document every prediction is `und` with score 0; equal texts get equal results; ties go to the language
first in order; an empty table gives an empty result. Columns besides key, text and (for fitting) language are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import least_hashes_of_each, map_texts, table, texts_of

MAX_TRAINING = 2_400
BUCKETS = 1 << 14
WINDOW = 1_000_000
EPOCHS = 3
ALPHA = 2.0
BETA = 1.0
L1 = 0.02
L2 = 0.001
SCALE = 100.0
UNDETERMINED = "und"

_GAP = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter; numerals of any script are none."""
    return any(map(str.isalpha, text or ""))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed one-, two- and three-grams of a whole text."""
    out = np.zeros(BUCKETS, dtype=np.int64)
    carried, gap, lowered = np.zeros(0, dtype=np.uint32), False, text.lower()
    for a in range(0, len(lowered), WINDOW):
        piece = _GAP.sub(" ", lowered[a : a + WINDOW])
        # A gap that a window's end cuts is one space all the same.
        piece, gap = piece[gap and piece[0] == " " :], piece[-1] == " "
        piece = " " * (a == 0) + piece + " " * (a + WINDOW >= len(lowered))
        own = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint32)
        c = np.concatenate([carried, own])
        h2 = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77) + np.uint32(0x27D4EB2F)
        h3 = h2[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x165667B1)
        h2 = h2[max(0, len(carried) - 1) :]
        out += np.bincount(np.concatenate([(own * np.uint32(0x2C1B3C6D)) >> np.uint32(18), h2 >> np.uint32(18), h3 >> np.uint32(18)]), minlength=BUCKETS)
        carried = c[-2:]
    return out


@dataclass
class Languages:
    """labels, idf-folded weights [bucket, label], bias, temperature."""

    labels: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        """Language and calibrated probability of each text."""
        names, scores = [], []
        for t in texts:
            if not self.labels or not has_letter(t):
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            counts = gram_counts(t)
            hit = np.flatnonzero(counts)
            z = ((counts[hit] / counts.sum()) @ self.weights[hit] + self.bias) / self.temperature
            p = np.exp(z - z.max())
            p /= p.sum()
            names.append(self.labels[int(p.argmax())])
            scores.append(float(p.max()))
        return names, scores


def inverse_frequencies(n: int, df: np.ndarray) -> np.ndarray:
    """Inverse document frequency of each bucket that df of n documents hold."""
    return np.log((1 + n) / (1 + df)) + 1


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray | None = None) -> Languages:
    """Learn from (buckets, counts, language) in the given order; every fifth row is kept for the temperature.

    idf comes from document_frequencies(); without it, that of the rows themselves is taken.
    """
    labels = sorted({r[2] for r in rows})
    if not labels:
        return Languages([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    k = len(labels)
    if idf is None:
        df = np.zeros(BUCKETS)
        for b, _, _ in rows:
            df[b] += 1
        idf = inverse_frequencies(len(rows), df)
    idf = idf * SCALE / 10
    data = [(b, c / c.sum() * idf[b], labels.index(lang)) for b, c, lang in rows]
    train, aside = [d for i, d in enumerate(data) if i % 5 or len(data) < 20], [d for i, d in enumerate(data) if not i % 5]
    z, n = np.zeros((BUCKETS, k)), np.zeros((BUCKETS, k))
    bz, bn = np.zeros(k), np.zeros(k)

    def weight(zz: np.ndarray, nn: np.ndarray, l1: float = L1) -> np.ndarray:
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((BETA + np.sqrt(nn)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for b, x, y in train:
            w, bias = weight(z[b], n[b]), weight(bz, bn, 0.0)
            s = x @ w + bias
            p = np.exp(s - s.max())
            g = p / p.sum()
            g[y] -= 1
            step = x[:, None] * g
            sigma = (np.sqrt(n[b] + step**2) - np.sqrt(n[b])) / ALPHA
            z[b] += step - sigma * w
            n[b] += step**2
            sigma = (np.sqrt(bn + g**2) - np.sqrt(bn)) / ALPHA
            bz += g - sigma * bias
            bn += g**2
    w, bias = weight(z, n), weight(bz, bn, 0.0)
    logits = np.array([x @ w[b] + bias for b, x, _ in aside])
    gold = np.array([y for _, _, y in aside])

    def loss(t: float) -> float:
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(gold)), gold]).mean())

    temperature = min((float(t) for t in np.geomspace(0.1, 10, 81)), key=loss)
    return Languages(labels, w * idf[:, None], bias, temperature)


def learnable(docs: DataFrame) -> DataFrame:
    """The documents that have an id and a language and are not held out."""
    return docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull()).where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Learnable documents with a letter, and how many of them hold each bucket: summed in the tasks and once more after the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for t in texts_of(batch.column(0)):
                if has_letter(t):
                    n += 1
                    df += gram_counts(t) > 0
        hit = np.flatnonzero(df)
        yield pa.record_batch([pa.array([-1, *hit], pa.int64()), pa.array([n, *df[hit]], pa.int64())], names=["bucket", "n"])

    out, n = np.zeros(BUCKETS, dtype=np.int64), 0
    for r in learnable(docs).select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r["bucket"] < 0:
            n = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return n, out


def training_rows(docs: DataFrame, bound: int = MAX_TRAINING) -> list[tuple[np.ndarray, np.ndarray, str]]:
    """n-gram counts and language of at most bound documents that are not held out, in the order of their hashes."""
    picked = least_hashes_of_each(learnable(docs).select(F.col("doc_id").alias("picked_id"), F.col("lang").alias("picked_lang")), "picked_id", "picked_lang", bound)
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(picked), (F.col("doc_id") == F.col("picked_id")) & (F.col("lang") == F.col("picked_lang"))).drop("picked_id", "picked_lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple, tuple[bytes, bytes]] = {}
        for batch in batches:
            for i, t, lang in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), texts_of(batch.column(2)), strict=True):
                if has_letter(t):
                    c = gram_counts(t)
                    hit = np.flatnonzero(c)
                    x = hit.astype("<u2").tobytes(), c[hit].astype("<u4").tobytes()
                    least[i, lang] = min(x, least.get((i, lang), x))
        columns = [[i for i, _ in least], [lang for _, lang in least], [x for x, _ in least.values()], [x for _, x in least.values()]]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.binary(), pa.binary()), strict=True)], names=["doc_id", "lang", "buckets", "counts"])

    once = rows.mapInArrow(run, "doc_id bigint, lang string, buckets binary, counts binary").groupBy("doc_id", "lang").agg(F.min(F.struct("buckets", "counts")).alias("x"))
    got = once.orderBy(F.xxhash64("doc_id"), "doc_id", "lang").select("lang", "x.*").collect()
    return [(np.frombuffer(r["buckets"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<u4").astype(float), r["lang"]) for r in got]


def identify(docs: DataFrame, model: Languages, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score."""

    def work(ids: list, texts: list) -> dict:
        names, scores = model.predict(texts)
        return {"doc_id": ids, "held_out": [i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids], "lang_pred": names, "score": scores}

    return map_texts(docs, key, text, "doc_id bigint, held_out boolean, lang_pred string, score double", work)


def op10_ftrl_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(training_rows(docs), inverse_frequencies(*document_frequencies(docs))))
