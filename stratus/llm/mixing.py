"""Mixing sources to target weights.

The words of each source are one stream, its documents in an order by hash, packed into blocks of BLOCK words; the last block of a source is what is left.
A source's target says how often its stream is taken: whole epochs of all its blocks, and a last epoch that stops at the word at which the
target is met. The slots of the mixture, one a block taken, are dealt to output shards: for each shard the counts of the sources are a multinomial draw with
the blocks still to be placed as weights, bounded by them, so that shards are random mixtures and totals meet the targets to the word.
A source's slots are numbered through all shards; the number gives epoch and place, a pseudorandom permutation of the source's full blocks,
other for each epoch, gives the block, and slots and blocks are joined by source and block.

Targets: weights share out all words; a target stops at MOST times its source's words, and the excess goes to the others by weight until none is
above. No document is taken more than MOST times.

Scale: one row a source, and for each shard a row of counts, pass through the driver, as the weights do; shards are at most MOST_SHARDS, and
fewer for many sources, so the counts are at most COUNTS. Places in a stream are sums in two steps, over buckets, as many as the root of the rows, and
within them, so of a source with a third of all rows no task gets more than about that root; equal rows are counted first and dealt out in chunks. A block
meets at most MOST + 1 slots and holds at most BLOCK documents with words.

Edge cases: a null text has no words; documents without words are returned with nothing taken; the null source is the last one; null
keys and repeated rows are rows like others; should all targets stop at their bound, they add up to less than all words; an empty table gives an empty result. Other
columns are not read. Reruns agree: everything follows from the rows and SEED, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.llm.common import BROADCAST_IDS, cut_lineage, table

BLOCK = 256
MOST = 3
WEIGHTS = (5, 2, 1)
SEED = 20
CHUNK = 1024
SHARD_SLOTS = 4096
MOST_SHARDS = 4096
COUNTS = 4_000_000
ROUNDS = 4

_SOURCES = "source string, rank bigint, source_size bigint, target double, whole bigint, tail bigint, epochs bigint, rest bigint, slots bigint"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """The words that each source is to give: shares by weight, none above `most` times its size, what that leaves shared by weight again."""
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        full = {i for i in free if left * weights[i] / total > most * sizes[i]}
        for i in full or free:
            out[i] = float(most * sizes[i]) if full else left * weights[i] / total
        if not full:
            break
        left -= sum(out[i] for i in full)
        free -= full
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0 to n - 1 for each key, at `index`: a balanced Feistel network on the next even number of bits, walked until it falls below n."""
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64) + 1)).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, b, m, k = out[todo], bits[todo], mask[todo], key.astype(np.uint64)[todo]
        left, right = x >> b, x & m
        for i in range(ROUNDS):
            left, right = right, left ^ (_scrambled(right ^ _scrambled(k + np.uint64(i + 1))) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= n.astype(np.uint64)[todo]]
    return out.astype(np.int64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def drawn(slots: list[int], seed: int = SEED, shard_slots: int = SHARD_SLOTS) -> np.ndarray:
    """Counts (shards x sources) that add up to the slots of each source; a shard's are a multinomial draw by what is left, no source giving more than it has."""
    left = np.array(slots, dtype=np.int64)
    total = int(left.sum())
    shards = int(max(1, min(-(-total // shard_slots), MOST_SHARDS, COUNTS // max(1, len(left)))))
    out = np.zeros((shards, len(left)), dtype=np.int64)
    for j in range(shards):
        rng, wanted = np.random.Generator(np.random.PCG64([seed, j])), total * (j + 1) // shards - total * j // shards
        while wanted:
            got = np.minimum(rng.multinomial(wanted, left / left.sum()), left)
            out[j] += got
            left -= got
            wanted -= int(got.sum())
    return out


def stream_items(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", texts: bool = False) -> DataFrame:
    """key, source, size, h, chunk, copies (and text, if asked): equal rows as one item for each CHUNK copies."""
    body = F.col(text).alias("text")
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), words_of(F.col(text)).alias("size"), F.xxhash64(text).alias("h"), *([body] if texts else []))
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / CHUNK)))
    return counted.withColumn("chunk", chunk).withColumn("copies", F.least(F.lit(CHUNK), F.col("n") - F.col("chunk") * CHUNK)).drop("n")


def sources_of(items: DataFrame, weights=WEIGHTS, block: int = BLOCK) -> list[tuple]:
    """One row a source, in code-point order and null last: what _SOURCES names. weights: a dict by source, or a sequence to be repeated in that order."""
    sizes = {r["source"]: r["size"] for r in items.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size")).collect()}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    of = [float(weights[s]) if isinstance(weights, dict) else float(weights[i % len(weights)]) for i, s in enumerate(names)]
    out = []
    for i, (s, target) in enumerate(zip(names, targets([sizes[s] for s in names], of), strict=True)):
        size, take = sizes[s], int(target + 0.5)
        whole, tail = divmod(size, block)
        epochs, rest = divmod(take, size) if size else (0, 0)
        out.append((s, i, size, target, whole, tail, epochs, rest, epochs * (whole + (tail > 0)) + -(-rest // block)))
    return out


def placed_items(items: DataFrame, sources: DataFrame, rows: int) -> DataFrame:
    """The items with `rank` and `place`: the first word in their source's stream."""
    buckets = max(1, isqrt(rows))
    ranked = items.join(sources.select("source", "rank").withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named"))).drop("named")
    ranked = ranked.withColumn("bucket", F.pmod(F.xxhash64("key", "h", "size", "chunk", F.lit(SEED)), F.lit(buckets)))
    amount = F.col("size") * F.col("copies")
    sums = ranked.groupBy("rank", "bucket").agg(F.sum(amount).alias("held"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("rank", "bucket").orderBy(F.xxhash64("key", "h", "size", "chunk"), "key", "h", "size", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranked.withColumn("within", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return counted.join(sums, ["rank", "bucket"]).withColumn("place", F.col("start") + F.col("within")).drop("bucket", "start", "within")


def documents_in_streams(items: DataFrame) -> DataFrame:
    """One row a document: the copies of placed items, each with its own place."""
    each = items.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    return each.withColumn("place", F.col("place") + F.col("copy") * F.col("size")).drop("copies")


def block_pieces(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """The blocks' contents: for each document and block that it reaches into, start (in the document), length, at (in the block)."""
    last = F.floor((F.col("place") + F.col("size") - 1) / block)
    cut = documents.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("place") / block), last)))
    low, high = F.greatest("place", F.col("block") * block), F.least(F.col("place") + F.col("size"), (F.col("block") + 1) * block)
    return cut.select("*", (low - F.col("place")).alias("start"), (high - low).alias("length"), (low - F.col("block") * block).alias("at"))


def mixture_slots(spark: SparkSession, sources: list[tuple], seed: int = SEED, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """shard, position, rank, epoch, block, words: every slot of the mixture, a task a range of shards."""
    counts = drawn([s[-1] for s in sources], seed, shard_slots)
    firsts = np.cumsum(counts, axis=0) - counts
    rows = [(j, i, int(counts[j, i]), int(firsts[j, i]), int(counts[j, :i].sum()), int(counts[j].sum())) for j, i in zip(*np.nonzero(counts), strict=True)]
    schema = "shard bigint, rank bigint, n bigint, first bigint, before bigint, of bigint"
    plan = spark.createDataFrame([(int(j), int(i), *r) for j, i, *r in rows], schema)
    known = spark.createDataFrame([s[1:] for s in sources], _SOURCES.removeprefix("source string, "))
    known = known.select("rank", "whole", "tail", "epochs", "rest")
    asked = plan.join(F.broadcast(known) if len(sources) <= BROADCAST_IDS else known, "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                for a in range(0, r["n"], 1 << 16):
                    k = np.arange(a, min(r["n"], a + (1 << 16)), dtype=np.int64)
                    yield _slots(r, k, seed, block)

    dealt = asked.repartition(max(1, min(len(counts), 4096)), "shard", "rank")
    return dealt.mapInArrow(run, "shard bigint, position bigint, rank bigint, epoch bigint, block bigint, words bigint")


def _slots(r: dict, k: np.ndarray, seed: int, block: int) -> pa.RecordBatch:
    """The k-th slots of a source in a shard."""
    full = lambda x: np.full(len(k), x, dtype=np.int64)
    in_epoch = r["whole"] + (r["tail"] > 0)
    epoch, i = np.divmod(r["first"] + k, in_epoch)
    # The full blocks of an epoch come in its own order, then what is left over.
    at = full(r["whole"])
    whole = np.flatnonzero(i < r["whole"])
    keys = np.array([seed, r["rank"]], dtype=np.uint64)
    at[whole] = permuted(i[whole], full(r["whole"])[whole], _scrambled(_scrambled(keys[:1]) + keys[1:] * np.uint64(0x10001)) + epoch[whole].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    words = np.where(i < r["whole"], block, r["tail"])
    words = np.where(epoch < r["epochs"], words, np.minimum(words, r["rest"] - i * block))
    position = permuted(r["before"] + k, full(r["of"]), np.full(len(k), r["shard"] * 2 + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(seed))
    names = {"shard": full(r["shard"]), "position": position, "rank": full(r["rank"]), "epoch": epoch, "block": at, "words": words}
    return pa.record_batch([pa.array(v) for v in names.values()], names=list(names))


def _planned(docs: DataFrame, key: str, text: str, source: str, weights, block: int, texts: bool) -> tuple[list[tuple], DataFrame, DataFrame]:
    """Sources as rows and as a table, and the documents in their streams."""
    items = cut_lineage(stream_items(docs, key, text, source, texts))
    known = sources_of(items, weights, block)
    named = docs.sparkSession.createDataFrame(known, _SOURCES)
    named = F.broadcast(named) if len(known) <= BROADCAST_IDS else named
    return known, named, cut_lineage(documents_in_streams(placed_items(items, named, items.count())))


def _joined(documents: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """Slots beside the pieces of their blocks, each cut where the slot ends."""
    # The planner would take the slots for as few as the rows that they are made of, and broadcast them.
    met = block_pieces(documents, block).join(slots.hint("shuffle_hash"), ["rank", "block"])
    return met.withColumn("taken", F.least("length", F.col("words") - F.col("at"))).where("taken > 0")


def taken(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: how many of its words the mixture takes of each document, repeats counted."""
    known, named, documents = _planned(docs, key, text, source, weights, block, texts=False)
    own = ["key", "rank", "size", "h", "chunk", "copy"]
    got = _joined(documents, mixture_slots(docs.sparkSession, known, block=block), block).select(*own, "taken")
    every = documents.select(*own, F.lit(0).cast("bigint").alias("taken")).union(got).groupBy(*own).agg(F.sum("taken").alias("taken"))
    return every.join(named, "rank").select(F.col("key").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def mixed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, block: int = BLOCK) -> DataFrame:
    """shard, position, source, text: the mixture itself, a row a slot with the words of its block, space-joined; ordered by shard and position it is the training stream."""
    known, named, documents = _planned(docs, key, text, source, weights, block, texts=True)
    piece = F.slice(F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0)), F.col("start").cast("int") + 1, F.col("taken").cast("int"))
    met = _joined(documents, mixture_slots(docs.sparkSession, known, block=block), block).select("shard", "position", "rank", "at", piece.alias("piece"))
    blocks = met.groupBy("shard", "position", "rank").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"))
    return blocks.join(named, "rank").select("shard", "position", "source", F.array_join(F.flatten("pieces.piece"), " ").alias("text"))


def op11_multinomial_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mixture takes of every document."""
    return taken(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")
