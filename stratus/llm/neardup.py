"""Near-duplicates by exact Jaccard similarity of word shingles, one row a group.

Texts are alike when the sets of their five-word shingles (lower case, as in simhash) have a Jaccard similarity of 0.8 or more;
groups are the components of that relation. Candidates come by op6's method, multi-index SimHash: fingerprints of the shingle sets that
simhash.links() finds within its two bits. That radius can't stand for the relation, as at 0.8 fingerprints differ in some ten of 64
bits, so MinHash adds candidates to it, in BANDS bands of ROWS minima, of which a pair at 0.8 shares one with a probability of
1 - (1 - 0.8**5)**32, all but 3 in a million. Every candidate pair of either kind is verified on the complete sets.

Scale: equal shingle sets are one class before anything is linked. A bucket of at most HEADS classes is compared pair by pair. In
a larger one every class is compared with the most central one; classes that end outside that one's component are taken as heads,
at most ROUND_HEADS and about HEAD_BYTES of shingles at a time, and sent to all classes of other components that share a bucket with
them, until none is left. So no candidate pair across components is passed over, and no rows are made for pairs of a large bucket; the comparisons there are the
number of classes outside the central component times the bucket's size. Shingle sets are made again for the classes in candidate pairs alone.

Edge cases: texts without words, null ones too, are one class; fewer than five words make one shingle of all of them. Of each group
the row of least key stays, keys before null, ties by a hash of the row, and of rows alike in every column one.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import simhash
from stratus.llm.common import BROADCAST_IDS, cut_lineage, least_row, one_row_of_each_group, parts_of, row_hash, texts_of
from stratus.llm.simhash import _LOWER, SEED, components

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 5
HEADS = 32
ROUND_HEADS = 1000
HEAD_BYTES = 32 << 20
CHUNK = 4096

_R = random.Random(11)
_A, _B, _MIX = (np.array([_R.getrandbits(64) | 1 for _ in range(BANDS * ROWS)], dtype=np.uint64) for _ in range(3))
_BAND = np.array([_R.getrandbits(64) for _ in range(BANDS)], dtype=np.uint64)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 values of the shingles of one text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()][: max(1, len(words) - width + 1)]
    pieces = [joined[a:b] for a, b in zip(starts, ends[min(width, len(words)) - 1 :].tolist(), strict=True)]
    return np.unique(np.fromiter(map(xxh64_intdigest, pieces, repeat(SEED)), dtype=np.uint64, count=len(pieces)))


def class_of(values: np.ndarray) -> int:
    """Signed hash of a whole set; 0 for the empty one."""
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(values.astype("<u8").tobytes(), SEED)).astype(np.int64)) if len(values) else 0


def bands(values: np.ndarray) -> np.ndarray:
    """A key for each band of the set's minima, none for the empty set."""
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(values), CHUNK):
        least = np.minimum(least, (_A[:, None] * values[None, i : i + CHUNK] + _B[:, None]).min(axis=1))
    mixed = (least ^ (least >> np.uint64(29))) * _MIX
    return ((mixed ^ (mixed >> np.uint64(32))).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _BAND).astype(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, row, class, fp (the set's fingerprint), bands of each row."""
    cols = docs.select(F.col(key).alias("doc_id"), row_hash(docs).alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 2):
                sets = [shingles(t) for t in texts_of(part.column(2))]
                keys = pa.array([bands(s).tolist() for s in sets], pa.list_(pa.int64()))
                fps = np.array([simhash.majority(s) if len(s) else 0 for s in sets], dtype=np.uint64).astype(np.int64)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(map(class_of, sets), pa.int64()), pa.array(fps), keys], names=["doc_id", "row", "class", "fp", "bands"])

    return cols.mapInArrow(run, "doc_id bigint, row bigint, class bigint, fp bigint, bands array<bigint>")


def by_fingerprint(classes: DataFrame) -> DataFrame:
    """a, b: classes (class, fp) to compare, whose fingerprints multi-index hashing links; of those with one fingerprint the least stands for it."""
    held = cut_lineage(classes.groupBy("fp").agg(F.min("class").alias("least"), F.count("*").alias("n")))
    same = classes.join(held.where("n > 1"), "fp").where("class <> least").select(F.col("least").alias("a"), F.col("class").alias("b"))
    near = simhash.links(held.select("fp"))
    least = lambda c: held.select(F.col("fp").alias(c), F.col("least").alias(f"of_{c}")).hint("shuffle_hash")
    linked = near.join(least("a"), "a").join(least("b"), "b").select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b"))
    return same.unionByName(linked)


def _sets(docs: DataFrame, text: str, rows: DataFrame) -> DataFrame:
    """class, members (the sorted set) of the texts in `rows` (row)."""
    rows = F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows.hint("shuffle_hash")
    wanted = docs.select(row_hash(docs).alias("row"), F.col(text).alias("text")).join(rows, "row", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 0):
                sets = [shingles(t) for t in texts_of(part.column(0))]
                yield pa.record_batch([pa.array(map(class_of, sets), pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["class", "members"])

    return wanted.mapInArrow(run, "class bigint, members binary").dropDuplicates(["class"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """a, b of the pairs whose sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 2, 3):
                left, right = ([np.frombuffer(x, "<u8") for x in part.column(i).to_pylist()] for i in (2, 3))
                yield part.select(["a", "b"]).filter(pa.array([jaccard(x, y) >= similarity for x, y in zip(left, right, strict=True)], pa.bool_()))

    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("members").alias("x")), "a").join(sets.select(F.col("class").alias("b"), F.col("members").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def links(docs: DataFrame, classes: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """node, root: the components of the classes (class, row, fp, bands) that are alike."""
    near = cut_lineage(by_fingerprint(classes.select("class", "fp")))
    entries = classes.select("class", F.explode("bands").alias("band")).repartition("band")
    sizes = entries.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    entries = cut_lineage(entries.join(sizes.hint("shuffle_hash"), "band").select("band", "class", "n"))
    compared = entries.select("class").union(near.select("a")).union(near.select("b")).distinct()
    sets = cut_lineage(_sets(docs, text, classes.join(compared, "class", "left_semi").select("row").distinct()))
    small = entries.where(F.col("n") <= HEADS).groupBy("band").agg(F.collect_list("class").alias("xs"))
    pairs = small.select(F.explode("xs").alias("a"), "xs").select("a", F.explode("xs").alias("b")).where("a < b")
    large = entries.where(F.col("n") > HEADS).select("band", "class", "n")
    # The class that shares most with others is likest to the text that copies were made of.
    score = large.groupBy("class").agg(F.sum("n").alias("score"))
    middles = cut_lineage(large.join(score, "class").groupBy("band").agg(F.max(F.struct("score", "class")).alias("m")).select("band", F.col("m.class").alias("middle")))
    around = large.join(middles, "band").where("middle <> class").select(F.least("middle", "class").alias("a"), F.greatest("middle", "class").alias("b"))
    edges = cut_lineage(_verified(pairs.union(around).union(near).distinct(), sets, similarity))
    roots = cut_lineage(components(edges))
    if middles.isEmpty():
        return roots
    of_class = cut_lineage(large.groupBy("class").agg(F.collect_list("band").alias("bands")).join(sets, "class"))
    heads = None
    while True:
        rooted = of_class.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
        middle = middles.join(roots.withColumnRenamed("node", "middle"), "middle", "left").select("band", F.coalesce("root", "middle").alias("middle_root"))
        rest = rooted.select("class", "root", F.explode("bands").alias("band")).join(middle, "band").where("root <> middle_root").select("class").distinct()
        rest = rest if heads is None else rest.join(heads, "class", "left_anti")
        sized = rest.join(of_class.select("class", F.length("members").alias("bytes")), "class").limit(ROUND_HEADS).collect()
        if not sized:
            return roots
        # The sets of a round's heads pass through the driver, so their bytes are bounded as well as their number.
        total = [sum(r["bytes"] for r in sized[: k + 1]) for k in range(len(sized))]
        picked = [(r["class"],) for k, r in enumerate(sized) if k == 0 or total[k] <= HEAD_BYTES]
        now = docs.sparkSession.createDataFrame(picked, "class bigint")
        found = cut_lineage(_across(rooted, rooted.join(F.broadcast(now), "class", "left_semi").collect(), similarity))
        heads = cut_lineage(now if heads is None else heads.union(now))
        if not found.isEmpty():
            edges = cut_lineage(edges.union(found))
            roots = cut_lineage(components(edges))


def _across(rooted: DataFrame, heads: list, similarity: float) -> DataFrame:
    """a, b: the heads that a class (class, bands, members, root) of another component shares a bucket with and is alike to."""
    by_band: dict[int, list[int]] = {}
    for k, h in enumerate(heads):
        for band in h["bands"]:
            by_band.setdefault(band, []).append(k)
    held = rooted.sparkSession.sparkContext.broadcast(([(h["class"], h["root"], bytes(h["members"])) for h in heads], by_band))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, buckets = held.value
        sets = [np.frombuffer(x, "<u8") for _, _, x in rows]
        for batch in (part for batch in batches for part in parts_of(batch, 2)):
            out = []
            for c, keys, x, root in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                own = np.frombuffer(x, "<u8")
                for k in {k for key in keys for k in buckets.get(key, ())}:
                    n, m = sorted((len(own), len(sets[k])))
                    if rows[k][1] != root and n >= similarity * m and jaccard(own, sets[k]) >= similarity:
                        out.append((min(c, rows[k][0]), max(c, rows[k][0])))
            yield pa.record_batch([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    return rooted.select("class", "bands", "members", "root").mapInArrow(run, "a bigint, b bigint").distinct()


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group, with all its columns."""
    rows = cut_lineage(_sketches(docs, key, text))
    classes = cut_lineage(rows.groupBy("class").agg(F.min(least_row()).alias("best"), F.first("fp").alias("fp"), F.first("bands").alias("bands")).select("class", "best", "best.row", "fp", "bands"))
    return one_row_of_each_group(docs, rows, classes, links(docs, classes, text, similarity))
