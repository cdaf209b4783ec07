"""Hard negatives by a vector-approximation file.

The rows lie in blocks of at most BLOCK_ROWS. In each block every dimension is cut into CELLS cells of about as many rows each; the
block's approximation holds one byte a dimension, the number of the cell, beside the least and the largest value of each cell. For an anchor,
two tables give what each cell of each dimension adds to the score at least and at most, and the sums of looked-up entries bound the
score of every row. Only rows whose bounds say that they may enter a window are scored exactly, on their whole vectors. The first search
finds an anchor's positives, whose windows take in any score; their scores then bound the windows of the second one. A bound never
excludes a row that belongs in a window, so results are exact.

A vector's components are floor(256 * x), a score is the integer inner product, higher scores come first and ties go by the lesser id.
An anchor's positives are its first POSITIVES other rows of the same label; a positive's negatives are the first NEGATIVES rows of other
labels whose scores lie between LOW and HIGH hundredths of the positive's.

Scale: anchors, every ANCHOR_EVERY-th id, meet all rows block by block: a block of rows and one of anchors are a row of the join each, which
goes by the number of the anchor block and a part of the row blocks, so that its keys are even. Anchor blocks are broadcast only if their bytes,
counted, are few. A pair of blocks gives at most POSITIVES or NEGATIVES rows for each window, merged by window functions that cut before they shuffle.
Copies of one vector need no care, as no bucket is made by value; a task holds a block of rows and bounds for ANCHORS_AT_ONCE anchors.

Edge cases: rows with a null label, a null vector or a null, NaN or infinite component take no part, nor do those whose components pass
LARGEST, as their scores fit no long, or those with a null id, which can't be ranked. Rows alike in id, label and vector count once; rows
that share an id alone are rows of their own, tied by label and then by components. Vectors of different lengths are scored on what both have. An empty
table gives an empty result; columns besides the three are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.llm.common import cut_lineage, table

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
ANCHOR_EVERY = 100
LARGEST = 1 << 24
CELLS = 64
BLOCK_ROWS = 4096
ANCHORS_A_BLOCK = 2048
ANCHORS_AT_ONCE = 128
BROADCAST_BYTES = 32 << 20
#: Row blocks are dealt over so many parts of each anchor block where anchors are shuffled.
PARTS = 64

_BLOCKS = "block bigint, ids binary, labels binary, vectors binary, codes binary, lows binary, highs binary"
_ANCHORS = "part int, keys binary, ids binary, labels binary, vectors binary, windows binary"


def scored_rows(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label") -> DataFrame:
    """id, label, v (whole components) of the distinct rows that take part."""
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * 256))
    whole = F.forall(F.col(vector), lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST / 256, F.lit(False)))
    label = F.col(label) if isinstance(label, str) else label
    kept = rows.where(F.col(key).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & whole)
    return kept.select(F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"), x.cast("array<int>").alias("v")).distinct()


def cells_of(vectors: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """codes (rows x dimensions), and the least and largest value of each cell (dimensions x cells).

    Cells are cut at quantiles of the block's values; equal values share a cell. Cells without rows hold zeros and are never looked up.
    """
    n, d = vectors.shape
    codes = np.zeros((n, d), dtype=np.uint8)
    lows, highs = np.zeros((d, cells), dtype=np.int64), np.zeros((d, cells), dtype=np.int64)
    for j in range(d):
        column = np.sort(vectors[:, j])
        cuts = np.unique(column[np.arange(1, cells) * n // cells])
        codes[:, j] = np.searchsorted(cuts, vectors[:, j], side="right")
        first = np.searchsorted(column, cuts, side="left")
        starts, ends = np.concatenate([[0], first]), np.concatenate([first, [n]])
        held = np.flatnonzero(ends > starts)
        lows[j, held], highs[j, held] = column[starts[held]], column[ends[held] - 1]
    return codes, lows, highs


def bounds(anchors: np.ndarray, codes: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score (rows x anchors) by sums of table entries, one lookup for each row and dimension.

    Sums are 32-bit integers where they are sure to fit, and 64-bit ones else.
    """
    n, d = codes.shape
    most = int((np.abs(anchors).max(axis=0, initial=0) * np.maximum(np.abs(lows), np.abs(highs)).max(axis=1, initial=0)).sum()) if len(anchors) else 0
    kind = np.int32 if most < 1 << 31 else np.int64
    least, largest = np.zeros((n, len(anchors)), dtype=kind), np.zeros((n, len(anchors)), dtype=kind)
    for j in range(d):
        a, b = np.multiply.outer(lows[j], anchors[:, j]), np.multiply.outer(highs[j], anchors[:, j])
        least += np.minimum(a, b).astype(kind)[codes[:, j]]
        largest += np.maximum(a, b).astype(kind)[codes[:, j]]
    return least, largest


def may_enter(least: np.ndarray, largest: np.ndarray, low: float, high: float, first: int) -> np.ndarray:
    """Rows that may be among the first in a window of scores from low to high: `first` rows that surely lie in it set the mark to reach."""
    sure = least[(least >= low) & (largest <= high)]
    mark = np.partition(sure, len(sure) - first)[len(sure) - first] if len(sure) >= first else low
    return np.flatnonzero((largest >= max(mark, low)) & (least <= high))


def blocks(rows: DataFrame) -> DataFrame:
    """The approximation file: rows (id, label, v) in blocks, each with its vectors, codes and cells; made once, kept in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                vectors = padded(part.column(2))
                ids, labels = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                # Ordered by label, so that a label's rows stand together, then as ties go.
                order = np.lexsort([*vectors.T[::-1], ids, labels])
                vectors, ids, labels = vectors[order], ids[order], labels[order]
                codes, lows, highs = cells_of(vectors)
                raw = [ids.astype("<i8"), labels.astype("<i8"), vectors.astype("<i4"), codes, lows.astype("<i4"), highs.astype("<i4")]
                number = ((task.partitionId() if task else 0) << 32) + k
                k += 1
                yield pa.record_batch([pa.array([number], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in raw)], names=[c.split()[0] for c in _BLOCKS.split(", ")])

    return cut_lineage(rows.select("id", "label", "v").mapInArrow(run, _BLOCKS))


def padded(column: pa.Array) -> np.ndarray:
    """Lists as rows of as many numbers as the longest has; shorter ones end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), lengths.max(initial=0)), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _opened(row: dict) -> tuple[np.ndarray, ...]:
    """ids, labels, vectors, codes, lows, highs of a block."""
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
    d = len(row["codes"]) // len(ids)
    vectors = np.frombuffer(row["vectors"], "<i4").reshape(len(ids), d).astype(np.int64)
    codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), d)
    lows, highs = (np.frombuffer(row[k], "<i4").reshape(d, CELLS).astype(np.int64) for k in ("lows", "highs"))
    return ids, labels, vectors, codes, lows, highs


def _keys(block: int, n: int) -> np.ndarray:
    """Numbers of a block's rows, unique in the file."""
    return block * BLOCK_ROWS + np.arange(n, dtype=np.int64)


def anchor_rows(file: DataFrame, every: int = ANCHOR_EVERY) -> DataFrame:
    """key, id, label, vector of the file's rows whose id `every` divides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, vectors, *_ = _opened(row)
                at = np.flatnonzero(ids % every == 0)
                yield pa.record_batch([pa.array(_keys(row["block"], len(ids))[at]), pa.array(ids[at]), pa.array(labels[at]), pa.array([vectors[i].astype("<i4").tobytes() for i in at], pa.binary())], names=["key", "id", "label", "vector"])

    return file.mapInArrow(run, "key bigint, id bigint, label bigint, vector binary")


def anchor_blocks(anchors: DataFrame) -> tuple[DataFrame, int]:
    """Blocks of anchors (key, id, label, vector, scores: those of the positives found, or null) and how many there are."""
    n = anchors.count()
    parts = max(1, -(-n // ANCHORS_A_BLOCK))

    def run(part: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("key")
        scores = group["scores"].to_pylist()
        windows = np.array([[*(s or []), *[np.iinfo(np.int64).min] * (POSITIVES - len(s or []))] for s in scores], dtype="<i8")
        raw = [group[k].to_numpy().astype("<i8").tobytes() for k in ("key", "id", "label")]
        vectors = group["vector"].to_pylist()
        longest = max(map(len, vectors))
        raw += [b"".join(v.ljust(longest, b"\0") for v in vectors), windows.tobytes()]
        return pa.table({"part": pa.array([part[0].as_py()], pa.int32()), **{k: pa.array([v], pa.binary()) for k, v in zip(("keys", "ids", "labels", "vectors", "windows"), raw, strict=True)}})

    dealt = anchors.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInArrow(run, _ANCHORS), parts


def _met(file: DataFrame, anchors: DataFrame, parts: int) -> DataFrame:
    """Every block of rows beside every block of anchors."""
    anchors = cut_lineage(anchors)
    size = anchors.agg(F.sum(F.length("vectors") + F.length("windows") + 3 * F.length("ids"))).first()[0] or 0
    anchors = anchors.select("part", F.col("keys").alias("a_keys"), F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), F.col("vectors").alias("a_vectors"), "windows")
    asked = file.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    if size <= BROADCAST_BYTES:
        return asked.join(F.broadcast(anchors), "part")
    asked = asked.withColumn("deal", F.pmod(F.xxhash64("block"), F.lit(PARTS)))
    dealt = anchors.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    return asked.join(dealt.hint("shuffle_hash"), ["part", "deal"]).drop("deal")


def _search(met: DataFrame, find, schema: str) -> DataFrame:
    """find(block, anchors) -> columns, for pairs of blocks; a row with both at a time."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, labels, vectors, codes, lows, highs = _opened(row)
                keys, a_ids, a_labels = (np.frombuffer(row[f"a_{k}"], "<i8") for k in ("keys", "ids", "labels"))
                a_vectors = np.frombuffer(row["a_vectors"], "<i4").reshape(len(a_ids), -1).astype(np.int64)
                windows = np.frombuffer(row["windows"], "<i8").reshape(len(a_ids), POSITIVES)
                d = min(vectors.shape[1], a_vectors.shape[1])
                block = (_keys(row["block"], len(ids)), ids, labels, vectors[:, :d], codes[:, :d], lows[:d], highs[:d])
                got = list(find(block, (keys, a_ids, a_labels, a_vectors[:, :d], windows)))
                if got:
                    columns = [np.concatenate(c) for c in zip(*got, strict=True)]
                    yield pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], names=names)

    return met.mapInArrow(run, schema)


def _chunks(picked: np.ndarray) -> Iterator[np.ndarray]:
    for at in range(0, len(picked), ANCHORS_AT_ONCE):
        yield picked[at : at + ANCHORS_AT_ONCE]


def _first(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n first: by score, then id, then place in the block."""
    return np.lexsort([rows, ids[rows], -scores])[:n]


def _positives(block: tuple, anchors: tuple) -> Iterator[tuple]:
    keys, ids, labels, vectors, codes, lows, highs = block
    a_keys, a_ids, a_labels, a_vectors, _ = anchors
    for label in np.unique(a_labels):
        a, b = np.searchsorted(labels, label, "left"), np.searchsorted(labels, label, "right")
        if a == b:
            continue
        for some in _chunks(np.flatnonzero(a_labels == label)):
            least, largest = bounds(a_vectors[some], codes[a:b], lows, highs)
            for k, i in enumerate(some):
                # One more than asked for, as the anchor itself may be among them.
                rows = a + may_enter(least[:, k], largest[:, k], -np.inf, np.inf, POSITIVES + 1)
                rows = rows[keys[rows] != a_keys[i]]
                scores = vectors[rows] @ a_vectors[i]
                best = _first(scores, rows, ids, POSITIVES)
                if len(best):
                    same = np.full(len(best), 1, dtype=np.int64)
                    yield same * a_keys[i], same * a_ids[i], keys[rows[best]], ids[rows[best]], scores[best]


def _negatives(block: tuple, anchors: tuple) -> Iterator[tuple]:
    keys, ids, labels, vectors, codes, lows, highs = block
    a_keys, _, a_labels, a_vectors, windows = anchors
    none = np.iinfo(np.int64).min
    for some in _chunks(np.arange(len(a_keys))):
        least, largest = bounds(a_vectors[some], codes, lows, highs)
        for k, i in enumerate(some):
            other = np.flatnonzero(labels != a_labels[i])
            low, high = least[other, k], largest[other, k]
            for score in np.unique(windows[i][windows[i] != none]).tolist():
                # Of whole scores, those from the first to the last that lie in the window.
                first, last = -(-LOW * score // 100), HIGH * score // 100
                if first > last:
                    continue
                rows = other[may_enter(low, high, first, last, NEGATIVES)]
                scores = vectors[rows] @ a_vectors[i]
                inside = (scores >= first) & (scores <= last)
                rows, scores = rows[inside], scores[inside]
                best = _first(scores, rows, ids, NEGATIVES)
                if len(best):
                    same = np.full(len(best), 1, dtype=np.int64)
                    yield same * a_keys[i], same * score, keys[rows[best]], ids[rows[best]], scores[best]


def hard_negatives(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label", every: int = ANCHOR_EVERY) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    file = blocks(scored_rows(rows, key, vector, label))
    anchors = cut_lineage(anchor_rows(file, every))
    found = _search(_met(file, *anchor_blocks(anchors.withColumn("scores", F.lit(None).cast("array<bigint>")))), _positives, "anchor bigint, anchor_id bigint, row bigint, positive_id bigint, positive_score bigint")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "row"))
    positives = cut_lineage(found.withColumn("place", place).where(F.col("place") <= POSITIVES).drop("row"))
    windows = positives.groupBy(F.col("anchor").alias("key")).agg(F.collect_list("positive_score").alias("scores"))
    mined = _search(_met(file, *anchor_blocks(anchors.join(windows, "key"))), _negatives, "anchor bigint, positive_score bigint, row bigint, negative_id bigint, negative_score bigint")
    rank = F.row_number().over(Window.partitionBy("anchor", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "row"))
    negatives = mined.withColumn("rank", rank).where(F.col("rank") <= NEGATIVES).drop("row")
    # Positives of equal score share a window and so its rows.
    return positives.join(negatives, ["anchor", "positive_score"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op13_approximation_file_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The negatives of every hundredth row; labels of every seventh one are moved on first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


OP13_SQL = """with parts as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as lab, embedding from embeddings where vec_id is not null and label is not null and embedding is not null),
whole as (select distinct vec_id, lab, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from parts where coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)),
scored as (select a.vec_id as anchor_id, a.lab as anchor_lab, b.vec_id as id, b.lab as lab, list_inner_product(a.v::double[], b.v::double[])::bigint as score
    from whole a join whole b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (select anchor_id, anchor_lab, id as positive_id, score as positive_score from scored where lab = anchor_lab
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
mined as (select p.anchor_id, p.positive_id, p.positive_score, s.id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.id) as place
    from positives p join scored s on s.anchor_id = p.anchor_id and s.lab <> p.anchor_lab and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score)
select anchor_id, positive_id, place::int as "rank", negative_id, positive_score, negative_score from mined where place <= 10"""
