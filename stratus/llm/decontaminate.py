"""Benchmark decontamination by greedy string tiling.

Documents and test items become word sequences (lower case; punctuation and spaces of all of Unicode separate words, and in scripts
without spaces each character is a word). Karp-Rabin hashes of MIN_MATCH words find the windows that a document shares with an item.
For each such pair the longest common run of words that are not marked yet is marked, again and again, until none of MIN_MATCH words
is left; the share of the item's words that are marked is its coverage. As runs are tiled in any order, passages that were reordered
in a document are caught.

Scale: documents are read once a block of items, streamed, never shuffled. A block holds about BLOCK_BYTES of item text at most (that is
checked by an aggregate, and larger benchmarks are taken in several blocks), so what tasks and the driver hold is bounded. A pair's
memory follows the document and the item, however repetitive they are.

Edge cases: null texts have no words; items under MIN_MATCH words match when whole and consecutive, even one word; items repeated with the same id and text count once; a
null item id is carried as null; ties in length go to the earlier place in the item, then in the document; repeated documents are reported
each; empty tables give an empty result. Columns besides keys and texts are not read (drop_contaminated() keeps them).
"""

from __future__ import annotations

import bisect
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import cut_lineage, map_texts, parts_of, table, texts_of

MIN_MATCH = 5
COVERAGE = 0.6
BLOCK_BYTES = 16 << 20

_WORD_BYTES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a whole text."""
    return (text or "").lower().encode("utf-8", "replace").translate(_WORD_BYTES).split()


# Scripts without spaces: Thai, Lao, Myanmar, Khmer, kana and Han with their extensions.
_SINGLE = ((0x0E01, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x323AF))


class _Separated(dict):
    """What stands for each character: itself, a space, nothing (marks of format) or itself between spaces."""

    def __missing__(self, code: int) -> str:
        c, kind = chr(code), unicodedata.category(chr(code))
        if code < 128:
            out = c if c.isalnum() else " "
        elif kind[0] in "PZ" or kind == "Cc" or code == 0x200B:
            out = " "
        elif kind == "Cf":
            out = ""
        else:
            out = f" {c} " if any(a <= code <= b for a, b in _SINGLE) else c
        self[code] = out
        return out


_SEPARATED = _Separated()


def tokens_of(text: str | None) -> list[bytes]:
    """Words to be matched: those of words_of for ASCII; beyond it separators of Unicode split, and single characters of some scripts."""
    text = text or ""
    return words_of(text) if text.isascii() else text.lower().translate(_SEPARATED).encode("utf-8", "replace").split()


_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The powers 0 to n of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) <= n:
        size = 1 << n.bit_length()
        for k, x in enumerate((_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            _POWERS[k] = np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(size, x))])
    return _POWERS


class Words:
    """Word numbers of a text with the sums from which the Karp-Rabin hash of any window follows."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        base, self.inverse = _powers(len(ids))
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(ids.astype(np.uint64) * base[: len(ids)])])

    def __len__(self) -> int:
        return len(self.ids)

    def hashes(self, at: np.ndarray, width: int) -> np.ndarray:
        """Hash of the window of so many words at each place, modulo 2**64."""
        return (self.sums[at + width] - self.sums[at]) * self.inverse[at]


def _member(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values of x are in `of`, which is sorted."""
    if not len(of):
        return np.zeros(len(x), dtype=bool)
    return of[np.minimum(np.searchsorted(of, x), len(of) - 1)] == x


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The whole numbers of the ranges first..last-1, one range after another."""
    n = last - first
    return np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


@dataclass
class Items:
    """A block of items: words numbered from 1, the windows' hashes of each item by place, and of all items in order."""

    ids: list
    numbers: dict[bytes, int]
    tokens: list[Words]
    windows: list[np.ndarray]
    hashes: np.ndarray
    item: np.ndarray
    #: Items under MIN_MATCH words, by their number of words and those words.
    short: dict[int, dict[tuple, list[int]]] = field(default_factory=dict)

    @staticmethod
    def of(rows: list[tuple[object, str]]) -> Items:
        numbers: dict[bytes, int] = {}
        tokens = [Words(np.array([numbers.setdefault(w, len(numbers) + 1) for w in tokens_of(t)], dtype=np.int64)) for _, t in rows]
        windows = [t.hashes(np.arange(max(0, len(t) - MIN_MATCH + 1)), MIN_MATCH) for t in tokens]
        hashes = np.concatenate([*windows, np.zeros(0, dtype=np.uint64)])
        item = np.repeat(np.arange(len(rows)), [len(w) for w in windows])
        order = np.argsort(hashes, kind="stable")
        short: dict[int, dict[tuple, list[int]]] = {}
        for k, t in enumerate(tokens):
            if 0 < len(t) < MIN_MATCH:
                short.setdefault(len(t), {}).setdefault(tuple(t.ids.tolist()), []).append(k)
        return Items([i for i, _ in rows], numbers, tokens, windows, hashes[order], item[order], short)

    def whole(self, doc: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, its words, 1) of each item under MIN_MATCH words that stands in the document."""
        out = []
        for width, by_words in self.short.items():
            at = _known(doc, width)
            if len(at):
                here = set(map(tuple, np.unique(np.stack([doc[at + j] for j in range(width)], axis=1), axis=0).tolist()))
                out += [(k, width, 1) for words in here & by_words.keys() for k in by_words[words]]
        return sorted(out)

    def matches(self, text: str | None, least: float = 0.0) -> list[tuple[int, int, int]]:
        """(item, marked words, tiles) of each item that shares a window with the text, or stands in it if it is short.

        Items whose shared windows cover less than the share `least` of their words are left out before they are tiled.
        """
        get = self.numbers.get
        doc = np.array([get(w, 0) for w in tokens_of(text)], dtype=np.int64)
        return self.whole(doc) + self.tiled(doc, least)

    def tiled(self, doc: np.ndarray, least: float = 0.0) -> list[tuple[int, int, int]]:
        """The same of items of MIN_MATCH words and more, one item after another: nothing is made for pairs of places."""
        at = _known(doc, MIN_MATCH)
        if not len(at) or not len(self.hashes):
            return []
        words = Words(doc)
        h = words.hashes(at, MIN_MATCH)
        hit = _member(h, self.hashes)
        if not hit.any():
            return []
        at, h = at[hit], h[hit]
        order = np.argsort(h, kind="stable")
        at, h = at[order], h[order]
        distinct = h[np.concatenate([[True], h[1:] != h[:-1]])]
        entries = _ranges(np.searchsorted(self.hashes, distinct, "left"), np.searchsorted(self.hashes, distinct, "right"))
        out = []
        for k in np.unique(self.item[entries]).tolist():
            item, own = self.tokens[k], self.windows[k]
            present = _member(own, distinct)
            if (np.convolve(present, np.ones(MIN_MATCH, dtype=np.int64)) > 0).sum() < least * len(item):
                continue
            mine = np.unique(own[present])
            places = np.sort(at[_ranges(np.searchsorted(h, mine, "left"), np.searchsorted(h, mine, "right"))])
            out.append((k, *tile(words, item, places, np.flatnonzero(present))))
        return out


def _known(doc: np.ndarray, width: int) -> np.ndarray:
    """Places of the windows all of whose words are words of items."""
    if len(doc) < width:
        return np.zeros(0, dtype=np.int64)
    known = np.concatenate([[0], np.cumsum(doc > 0)])
    return np.flatnonzero(known[width:] - known[:-width] == width)


def _reach(at: np.ndarray) -> np.ndarray:
    """From each of the ascending places, the longest window all of whose windows of MIN_MATCH words are among the places."""
    ends = np.flatnonzero(np.concatenate([np.diff(at) != 1, [True]]))
    return at[ends[np.searchsorted(ends, np.arange(len(at)))]] - at + MIN_MATCH


def tile(doc: Words, item: Words, at: np.ndarray, own: np.ndarray) -> tuple[int, int]:
    """Marked words of the item and number of tiles by greedy tiling; at and own: ascending places of shared windows of MIN_MATCH words.

    Each round finds the greatest width at which an unmarked window of the item has the hash of one of the document, marks what it can
    of that width, by place in the item and then in the document, words compared, and drops the places that a tile touches. A place
    is kept once, whatever it matches, and an item that is covered ends the search; so memory follows the document and the item,
    and widths found are at most about the root of twice the item's length, however repetitive both are.
    """
    marked = tiles = 0
    longest = len(item)
    while len(at) and len(own):
        reach_at, reach_own = _reach(at), _reach(own)

        def shared(width: int, at: np.ndarray = at, own: np.ndarray = own, reach_at: np.ndarray = reach_at, reach_own: np.ndarray = reach_own) -> tuple[np.ndarray, ...]:
            a, b = at[reach_at >= width], own[reach_own >= width]
            ha, hb = doc.hashes(a, width), item.hashes(b, width)
            keep_a = _member(ha, np.sort(hb))
            return a[keep_a], ha[keep_a], b, hb

        width = min(longest, int(reach_at.max()), int(reach_own.max()))
        found = shared(width)
        if not len(found[0]):
            low, high = MIN_MATCH - 1, width
            while high - low > 1:
                middle = (low + high) // 2
                got = shared(middle)
                if len(got[0]):
                    low, found = middle, got
                else:
                    high = middle
            if low < MIN_MATCH:
                break
            width = low
        starts = _placed(doc, item, width, *found)
        for a, b in starts:
            marked, tiles = marked + width, tiles + 1
            at = np.delete(at, slice(*np.searchsorted(at, [a - MIN_MATCH + 1, a + width])))
            own = np.delete(own, slice(*np.searchsorted(own, [b - MIN_MATCH + 1, b + width])))
        longest = width - 1
        if longest < MIN_MATCH:
            break
    return marked, tiles


def _placed(doc: Words, item: Words, width: int, a: np.ndarray, ha: np.ndarray, b: np.ndarray, hb: np.ndarray) -> list[tuple[int, int]]:
    """(place in the document, place in the item) of the tiles of one width, none longer being left."""
    order = np.argsort(ha, kind="stable")
    a, ha = a[order], ha[order]
    taken: list[int] = []
    next_at: dict[bytes, int] = {}
    out, free = [], 0
    for start, first, last in zip(b.tolist(), np.searchsorted(ha, hb, "left").tolist(), np.searchsorted(ha, hb, "right").tolist(), strict=True):
        if start < free or first == last:
            continue
        words = item.ids[start : start + width]
        key = words.tobytes()
        i = next_at.get(key, first)
        while i < last:
            place = int(a[i])
            k = bisect.bisect_right(taken, place)
            if k and place < taken[k - 1] + width:
                i = first + int(np.searchsorted(a[first:last], taken[k - 1] + width))
            elif k < len(taken) and taken[k] < place + width:
                i = first + int(np.searchsorted(a[first:last], taken[k] + width))
            elif not np.array_equal(doc.ids[place : place + width], words):
                i += 1
            else:
                break
        next_at[key] = i
        if i < last:
            bisect.insort(taken, place)
            out.append((place, start))
            free = start + width
    return out


def blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks of about block_bytes at most."""
    rows = benchmark.select(F.col(key).alias("item_id"), F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total * 2 // block_bytes)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        if part:
            yield Items.of([(r["item_id"], r["text"]) for r in part])


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, matched_words, item_words, tiles, coverage: one row for each document and item at or over the limit."""
    schema = "doc_id bigint, item_id bigint, matched_words bigint, item_words bigint, tiles bigint, coverage double"

    def over(items: Items) -> DataFrame:
        def work(ids: list, texts: list) -> dict:
            rows = [(i, items.ids[k], m, len(items.tokens[k]), n, m / len(items.tokens[k])) for i, t in zip(ids, texts, strict=True) for k, m, n in items.matches(t, coverage) if m >= coverage * len(items.tokens[k])]
            names = ("doc_id", "item_id", "matched_words", "item_words", "tiles", "coverage")
            return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}

        return map_texts(docs, key, text, schema, work)

    out = None
    for items in blocks(benchmark):
        # What earlier blocks found is written before the next one is sent, so that a plan holds one block.
        out = over(items) if out is None else cut_lineage(out).union(over(items))
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, text: str = "text") -> DataFrame:
    """The rows that hold no item at or over the limit, with all their columns."""
    at = docs.columns.index(text)

    def without(rows: DataFrame, items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in parts_of(batch, at):
                    clean = [not any(m >= coverage * len(items.tokens[k]) for k, m, _ in items.matches(t, coverage)) for t in texts_of(part.column(at))]
                    yield part.filter(pa.array(clean, type=pa.bool_()))

        return rows.mapInArrow(run, docs.schema)

    for k, items in enumerate(blocks(benchmark)):
        docs = without(cut_lineage(docs) if k else docs, items)
    return docs


def op9_greedy_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document holds."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
