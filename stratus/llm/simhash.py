"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint is the bitwise majority of the XXH64 values of its three-word shingles. Fingerprints link when they
differ in at most DISTANCE bits. The bits are cut into SEGMENTS segments; the table holds every fingerprint under each (segment, value).
Of two fingerprints that link, some segment differs in at most DISTANCE // SEGMENTS bits, so each fingerprint enumerates the small
Hamming ball around the value of each of its segments, fetches the table's fingerprints under those values, and verifies complete
distances. Of the two that differ in a segment only the one with a zero in the highest differing bit asks for the other.

Scale: texts with equal fingerprints are one class before anything is linked, so thousands of copies cost one index row. Near copies
share segment values, so a value may hold a large part of all classes: a value with more than HOT_VALUE classes is hot and is
not looked up. Every class with a hot value in one of its balls goes by all its segments at once instead, under the points of the
whole fingerprint's ball of radius one: two such classes link exactly if they own a common point, a point has at most 65 of
them, and each links to the point's least, verified again. So no value makes more than HOT_VALUE candidates a question, and no link is
lost. Components come from rounds of union-find within bounded partitions and large-star and small-star steps across them,
checkpointed; nothing is collected. Classes with more copies than a HOT_CLASSES-th of all rows, so at most HOT_CLASSES of them, reach
their documents by broadcast, all others by a shuffle; nodes with that share of the edges get their least neighbour the same way.

Edge cases: a null or wordless text has fingerprint zero and links like any other; fewer than three words make one shingle of all
of them; repeated rows share a component; a null doc_id can't be a component's id, and a component without any other id has null;
an empty table gives an empty result. Columns besides the key and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import BROADCAST_IDS, cut_lineage, least_row, map_texts, one_row_of_each_group, row_hash, table, texts_of

BITS = 64
SEGMENTS = 2
SEED = 42
SHINGLE = 3
DISTANCE = 2
PART_EDGES = 200_000
HOT_CLASSES = 500
HOT_VALUE = 64

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text from its shingles of so many words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    if n == 1:
        hashes = np.array([xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[:n].tolist()
        hashes = np.fromiter(map(xxh64_intdigest, [joined[a:b] for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], repeat(SEED)), dtype=np.uint64, count=n)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as one unsigned number."""
    lanes = hashes.astype("<u8").view(np.uint8).reshape(len(hashes), 8) + _LANES
    ones = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    set_bits = np.flatnonzero(ones.ravel() * 2 > len(hashes))
    return sum(1 << int(b) for b in set_bits)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""

    def work(ids: list, texts: list) -> dict:
        return {"doc_id": ids, "fp": np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).astype(np.int64)}

    return map_texts(docs, key, text, "doc_id bigint, fp bigint", work)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _key(segment: int, segments: int, fp: Column) -> Column:
    """The table's key for the value of a segment, a hash of both; should two collide, verification rejects what is fetched."""
    low, high = segment * BITS // segments, (segment + 1) * BITS // segments
    return F.xxhash64(F.lit(segment), fp.bitwiseAND(F.lit(_signed((1 << high) - (1 << low)))))


def table_entries(classes: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """key, fp: every fingerprint under the value of each of its segments."""
    return classes.select("fp", F.explode(F.array(*[_key(s, segments, F.col("fp")) for s in range(segments)])).alias("key"))


def ball_entries(classes: DataFrame, segments: int = SEGMENTS, distance: int = DISTANCE, upward: bool = True) -> DataFrame:
    """own, key, fp: for each segment of each fingerprint its own key and those of the ball around its value.

    upward leaves out values whose highest differing bit is one in the fingerprint: there, the other fingerprint asks.
    """

    def turned(s: int):
        return lambda v: F.struct(_key(s, segments, F.col("fp")).alias("own"), _key(s, segments, F.col("fp").bitwiseXOR(v["mask"])).alias("key"))

    balls = []
    for s in range(segments):
        bits = range(s * BITS // segments, (s + 1) * BITS // segments)
        masks = [(sum(1 << i for i in c), 1 << max(c, default=0)) for r in range(distance // segments + 1) for c in combinations(bits, r)]
        values = F.array(*[F.struct(F.lit(_signed(m)).cast("long").alias("mask"), F.lit(_signed(top) if m else 0).cast("long").alias("top")) for m, top in masks])
        asked = F.filter(values, lambda v: F.col("fp").bitwiseAND(v["top"]) == 0) if upward else values
        balls.append(F.transform(asked, turned(s)))
    return classes.select("fp", F.explode(F.concat(*balls)).alias("e")).select("e.own", "e.key", "fp")


def point_entries(classes: DataFrame) -> DataFrame:
    """point, fp: the ball of radius one around each whole fingerprint."""
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in (0, *(1 << i for i in range(BITS)))])
    return classes.select("fp", F.explode(masks).alias("mask")).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), "fp")


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def links(classes: DataFrame, segments: int = SEGMENTS, distance: int = DISTANCE, hot_value: int = HOT_VALUE) -> DataFrame:
    """a, b: distinct links a < b between fingerprints at most `distance` bits apart; they connect what any such pair connects.

    The points that stand in for hot values reach two bits, so `distance` is at most 2.
    """
    if not 0 <= distance <= 2 or segments < 2:
        raise ValueError("at most two bits and at least two segments")
    table = table_entries(classes, segments)
    hot = cut_lineage(table.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot_value).select("key"))
    asked = ball_entries(classes, segments, distance)
    some = not hot.isEmpty()
    if some:
        # Every hot value has over hot_value classes: the list is shorter than the classes by that factor, and broadcast only if it is small.
        hot = F.broadcast(hot) if hot.count() <= BROADCAST_IDS else hot.hint("shuffle_hash")
        entrants = cut_lineage(ball_entries(classes, segments, distance, upward=False).join(hot, "key", "left_semi").select("fp").distinct())
        table = table.join(hot, "key", "left_anti")
        asked = asked.join(hot, "key", "left_anti").join(hot.withColumnRenamed("key", "own"), "own", "left_anti")
    fetched = asked.select("key", F.col("fp").alias("a")).join(table.select("key", F.col("fp").alias("b")).hint("shuffle_hash"), "key")
    # Within one value both ask, so the lesser does; a pair may also be fetched under several segments.
    found = fetched.where((F.col("a") != F.col("b")) & _near("a", "b", distance)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if some:
        points = point_entries(entrants).repartition("point")
        heads = points.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("point", "a")
        around = points.join(heads.hint("shuffle_hash"), "point").where(F.col("a") < F.col("fp")).select("a", F.col("fp").alias("b"))
        found = found.union(around.where(_near("a", "b", 2))) if distance == 2 else found.union(_within(points, distance))
    return found.distinct()


def _within(points: DataFrame, distance: int) -> DataFrame:
    """a, b: pairs of a point that are nearer than two bits; a point has at most 65 fingerprints."""
    pairs = points.select("point", F.col("fp").alias("a")).join(points.select("point", F.col("fp").alias("b")).hint("shuffle_hash"), "point")
    return pairs.where((F.col("a") < F.col("b")) & _near("a", "b", distance)).select("a", "b")


def _contracted(edges: DataFrame, parts: int) -> DataFrame:
    """The edges of each of `parts` even partitions as stars around their components' smallest nodes, by union-find in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = find(a), find(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        stars = [(x, r) for x in list(parent) if (r := find(x)) != x]
        yield pa.record_batch([pa.array([x for x, _ in stars], pa.int64()), pa.array([r for _, r in stars], pa.int64())], names=["a", "b"])

    return edges.select("a", "b").repartition(parts).mapInArrow(run, "a bigint, b bigint")


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node has two roots, and no root has one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("b", F.lit(0), F.lit(1)))
    odd = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out > 0 and into > 0)")
    return odd.isEmpty()


def components(edges: DataFrame, max_rounds: int = 60, part_edges: int = PART_EDGES) -> DataFrame:
    """node, root: the smallest node that each node of the edges (a, b) reaches.

    Each round contracts partitions of about part_edges edges by themselves, and then joins what they found by a large-star and a
    small-star step, until only stars are left. Edges that fit one partition are done after the first contraction.
    """

    def star(e: DataFrame, large: bool, limit: int) -> DataFrame:
        both = e.union(e.select("b", "a")) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count("*").alias("n"))
        # A hub's edges would meet in one task: the few nodes with a HOT_CLASSES-th of the edges get their least by broadcast.
        hubs = F.broadcast(least.where(F.col("n") > limit).drop("n"))
        linked = both.join(hubs, "a").union(both.join(hubs.select("a"), "a", "left_anti").join(least.where(F.col("n") <= limit).drop("n"), "a"))
        least = least.drop("n")
        if large:
            out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    now = cut_lineage(edges.where("a <> b").select("a", "b"))
    for _ in range(max_rounds):
        n = now.count()
        parts = max(1, -(-n // part_edges))
        if parts == 1:
            now = cut_lineage(_contracted(now, 1))
            break
        limit = max(1, n // HOT_CLASSES)
        now = cut_lineage(star(cut_lineage(star(cut_lineage(_contracted(now, parts)), True, limit)), False, limit))
        if _settled(now):
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, segments: int = SEGMENTS, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the component)."""
    fps = cut_lineage(fingerprints(docs, key, text, width))
    classes = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    roots = components(links(classes.select("fp"), segments, distance))
    linked = classes.join(roots, F.col("fp") == F.col("node")).select("fp", "rep", "root")
    least = linked.groupBy("root").agg(F.min("rep").alias("least"))
    moved = linked.join(least, "root").select("fp", "least")
    of_class = cut_lineage(classes.join(moved, "fp", "left").select("fp", "copies", F.coalesce("least", "rep").alias("component_id")))
    limit = fps.count() // HOT_CLASSES
    hot = F.broadcast(of_class.where(F.col("copies") > limit).drop("copies"))
    rest = of_class.where(F.col("copies") <= limit).drop("copies")
    placed = fps.join(hot, "fp").unionByName(fps.join(hot.select("fp"), "fp", "left_anti").join(rest, "fp"))
    return placed.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, segments: int = SEGMENTS, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, with all its columns: that of the least key, keys before null; of rows alike in every column one."""
    cols = docs.select(F.col(key).alias("doc_id"), row_hash(docs).alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in texts_of(batch.column(2))], dtype=np.uint64).astype(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps)], names=["doc_id", "row", "class"])

    rows = cut_lineage(cols.mapInArrow(run, "doc_id bigint, row bigint, class bigint"))
    classes = cut_lineage(rows.groupBy("class").agg(F.min(least_row()).alias("best")).select("class", "best", "best.row"))
    return one_row_of_each_group(docs, rows, classes, components(links(classes.select(F.col("class").alias("fp")), segments, distance)))


def op6_multi_index_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
