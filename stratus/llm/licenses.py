"""Licence scans with a positional rare-token index.

The library holds whole licences and the notices by which files name them. A template of n words is found where a stretch of a file
comes within (1 - MATCH) * n word edits (words put in, left out or replaced) of it and every mandatory key phrase stands consecutively in
that stretch; its score is 1 - edits / n.

The index maps the rarest words of each template to their positions in it. A first pass over all documents counts how many
hold each licence word, which gives the words' inverse document frequencies. Of so many edits at most that many can strike a template's
rare positions, so of its allowed edits + VOTE * n rarest positions at least VOTE * n are left in place, all within a band of relative positions
as wide as the edits. In the second pass a file's rare words are looked up, their relative positions sorted, and only where a band
holds enough of them the template is aligned, word by word. So the index passes over nothing that an alignment along the whole
file would find.

Base labels come from exact phrases and always stay.

Edge cases: a null text is empty: no words, no labels, score 0; a file without licence words has score 0; equal texts have equal results;
ties in IDF go by word; repeated rows give a row each; an empty table gives an empty result. Columns besides key and text
are not read. The vocabulary of the templates bounds what is collected and sent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import map_texts, slices, table, texts_of
from stratus.llm.licence_texts import TEMPLATES

MATCH = 0.8
VOTE = 0.1

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))

# Phrases of the base labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text: lower-cased ASCII letters, digits and anything beyond ASCII."""
    return (text or "").encode().translate(_WORDS).split()


@dataclass
class Index:
    """Word numbers from 1 (0: no licence word), templates and phrases as numbers, document frequencies by word.

    held[t, w]: how often word w stands in template t; rare[t]: its positions to be looked up.
    """

    numbers: dict[bytes, int]
    labels: list[str]
    templates: list[np.ndarray]
    required: list[list[np.ndarray]]
    phrases: list[tuple[np.ndarray, str]]
    held: np.ndarray
    rare: list[np.ndarray]

    @staticmethod
    def of(templates=TEMPLATES, phrases=None) -> Index:
        numbers: dict[bytes, int] = {}
        as_ids = lambda t: np.array([numbers.setdefault(w, len(numbers) + 1) for w in words_of(t)], dtype=np.int64)
        bodies = [as_ids(t) for _, t, _ in templates]
        required = [[as_ids(p) for p in must] for _, _, must in templates]
        base = [(as_ids(p), label) for p, label in (phrases or PHRASES).items()]
        held = np.array([np.bincount(body, minlength=len(numbers) + 1) for body in bodies], dtype=np.int64).reshape(len(bodies), len(numbers) + 1)
        return Index(numbers, [label for label, _, _ in templates], bodies, required, base, held, []).weighed(np.zeros(len(numbers) + 1))

    def edits(self, t: int) -> int:
        """How many word edits a template may have."""
        return int((1 - MATCH) * len(self.templates[t]) + 1e-9)

    def votes(self, t: int) -> int:
        """How many of the rare positions must stand in place at least."""
        n = len(self.templates[t])
        return max(1, min(n - self.edits(t), int(VOTE * n)))

    def weighed(self, idf: np.ndarray) -> Index:
        """The index with the rare positions that the words' inverse document frequencies give; ties go by word and position."""
        spelled = sorted(self.numbers, key=self.numbers.get)
        self.rare = [np.array(sorted(range(len(body)), key=lambda q: (-idf[body[q]], spelled[body[q] - 1], q))[: self.edits(t) + self.votes(t)], dtype=np.int64) for t, body in enumerate(self.templates)]
        return self

    def ids(self, text: str | None) -> np.ndarray:
        """The licence-word numbers along a text."""
        get = self.numbers.get
        return np.array([get(w, 0) for w in words_of(text)], dtype=np.int64)

    def places(self, ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
        """Where a phrase stands consecutively."""
        n = len(ids) - len(phrase) + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        at = np.flatnonzero(ids[:n] == phrase[0])
        for j in range(1, len(phrase)):
            at = at[ids[at + j] == phrase[j]]
        return at

    def found(self, ids: np.ndarray) -> list[tuple[str, int, float]]:
        """(label, place, score) of each template and stretch that passes, the best end of a stretch, places ascending by template."""
        present = np.bincount(ids, minlength=self.held.shape[1]) > 0
        present[0] = False
        # The words of a template that occur anywhere bound what an alignment can find, so the other templates can't pass.
        able = [t for t, n in enumerate((self.held @ present).tolist()) if n >= len(self.templates[t]) - self.edits(t)]
        if not able:
            return []
        places = np.flatnonzero(ids)
        places = places[np.argsort(ids[places], kind="stable")]
        words = ids[places]
        out = []
        for t in able:
            for start, end in self.stretches(t, places, words, len(ids)):
                out += self.aligned(t, ids, start, end)
        return out

    def stretches(self, t: int, places: np.ndarray, words: np.ndarray, n: int) -> list[tuple[int, int]]:
        """The parts of a file in which enough rare positions agree; places: those of the licence words, by word."""
        body, edits = self.templates[t], self.edits(t)
        rare = body[self.rare[t]]
        first, last = np.searchsorted(words, rare, "left"), np.searchsorted(words, rare, "right")
        count = last - first
        at = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        offsets = np.sort(places[at] - np.repeat(self.rare[t], count))
        enough = np.searchsorted(offsets, offsets + edits, "right") - np.arange(len(offsets)) >= self.votes(t)
        out: list[tuple[int, int]] = []
        for x in offsets[enough].tolist():
            a, b = max(0, x - edits), min(n, x + len(body) + 2 * edits)
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out

    def aligned(self, t: int, ids: np.ndarray, start: int, end: int) -> list[tuple[str, int, float]]:
        """What a template gives in ids[start:end]: fewest edits by every end, from Myers' bit vectors over the template's positions."""
        body, edits = self.templates[t], self.edits(t)
        n = len(body)
        of: dict[int, int] = {}
        for q, w in enumerate(body.tolist()):
            of[w] = of.get(w, 0) | 1 << q
        full, top = (1 << n) - 1, 1 << (n - 1)
        plus, minus, now = full, 0, n
        good: list[tuple[int, int]] = []
        for e, w in enumerate(ids[start:end].tolist(), start):
            same = of.get(w, 0)
            vertical = same | minus
            across = (((same & plus) + plus) ^ plus) | same
            up, down = minus | (full & ~(across | plus)), plus & across
            now += bool(up & top) - bool(down & top)
            up, down = up << 1, down << 1
            plus, minus = (down | ~(vertical | up)) & full, up & vertical & full
            if now <= edits:
                good.append((e, now))
        out, k = [], 0
        while k < len(good):
            upto = k + 1
            while upto < len(good) and good[upto][0] - good[upto - 1][0] <= edits + 1:
                upto += 1
            # A stretch that ends at e has at most n + edits words.
            fit = [(d, e) for e, d in good[k:upto] if all(len(self.places(ids[max(0, e + 1 - n - edits) : e + 1], phrase)) for phrase in self.required[t])]
            if fit:
                d, e = min(fit)
                out.append((self.labels[t], max(0, e + 1 - n), 1.0 - d / n))
            k = upto
        return out


def document_frequencies(docs: DataFrame, index: Index, text: str = "text") -> tuple[int, np.ndarray]:
    """Documents, and how many hold each licence word: one row a word comes to the driver, summed before and after the shuffle."""
    size = len(index.numbers) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, df = 0, np.zeros(size, dtype=np.int64)
        vocabulary, number = frozenset(index.numbers), index.numbers.__getitem__
        for batch in batches:
            texts = texts_of(batch.column(0))
            for a, b in slices(texts):
                for t in texts[a:b]:
                    total += 1
                    df[list(map(number, vocabulary.intersection(words_of(t))))] += 1
        yield pa.record_batch([pa.array(np.arange(size)), pa.array(np.concatenate([[total], df[1:]]))], names=["word", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, dtype=np.int64)
    for r in rows:
        out[r["word"]] = r["n"]
    return int(out[0]), out


def index_for(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> Index:
    """The index with inverse document frequencies of all documents."""
    index = Index.of(templates)
    n, df = document_frequencies(docs, index, text)
    return index.weighed(np.log((1 + n) / (1 + df)))


def scan(docs: DataFrame, index: Index, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches (label@word, comma-joined)."""
    schema = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, matches string"

    def work(ids: list, texts: list) -> dict:
        names = [x.split(" ")[0] for x in schema.split(", ")]
        out: dict[str, list] = {n: [] for n in names}
        for doc, t in zip(ids, texts, strict=True):
            seq = index.ids(t)
            hits, base = [], set()
            if seq.any():
                for phrase, label in index.phrases:
                    at = index.places(seq, phrase)
                    hits.append(at)
                    base |= {label} if len(at) else set()
            at = np.concatenate(hits) if hits else np.zeros(0, dtype=np.int64)
            found = index.found(seq) if seq.any() else []
            row = (doc, len(seq), len(at), int(at.min()) if len(at) else None, int(at.max()) if len(at) else None, ",".join(sorted(base)), ",".join(sorted(base | {f[0] for f in found})), max((f[2] for f in found), default=1.0 if base else 0.0), ",".join(f"{label}@{p}" for label, p, _ in found))
            for n, v in zip(names, row, strict=True):
                out[n].append(v)
        return out

    return map_texts(docs, key, text, schema, work)


def op8_rare_token_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences in every document."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, index_for(docs))
