"""Sharding by fixed virtual slots, DataFrame functions only.

Every record hashes into one of some thousands of slots. The number of slots never changes; which shard owns a slot stands in
a small versioned map. Growing or rebalancing edits the map, so only the rows of the slots that change hands move.

Bounds: the map and the statistics by slot have one row a slot (at most MAX_SLOTS), whatever the size of the data, so they
may be broadcast and edited on the driver. Rows alike in key, size and checksum are counted first, before they are shuffled. The counted
rows are numbered within a slot's PARTS parts, tens of thousands of groups that the text's checksum divides further where one key
fills a slot, shifted by the rows of the shard's earlier parts, and then take as many places as they count, CHUNK places at a time; no
shard is ever sorted in one task, and no repeated row fills one.

Edge cases: a null key hashes like any other value; a null text has no bytes; rows that repeat get places of their own; an empty table gives an empty result. Columns that the caller has besides the key and the text are not read, so their names can't clash.
"""

from __future__ import annotations

import bisect
import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.llm.common import table

SLOTS = 8192
PARTS = 8
CHUNK = 10_000
MAX_SLOTS = 65536
SHARDS = 24
ROW_OVERHEAD = 8


@dataclass(frozen=True)
class SlotMap:
    """owner[s] is the shard of slot s; each edit gives a new version."""

    version: int
    shards: int
    owner: tuple[int, ...]

    @staticmethod
    def of(shards: int, slots: int = SLOTS) -> SlotMap:
        """The map for so many shards: grown shard by shard, so that the count alone decides it."""
        if not 1 <= shards <= slots <= MAX_SLOTS:
            raise ValueError(f"1 <= shards <= slots <= {MAX_SLOTS} is needed")
        m = SlotMap(1, 1, (0,) * slots)
        while m.shards < shards:
            m = m.grow()
        return m

    def grow(self) -> SlotMap:
        """One more shard: it takes its share of slots from the shards that own most; no other slot moves."""
        if self.shards >= len(self.owner):
            raise ValueError("as many shards as slots")
        owned: dict[int, list[int]] = {k: [] for k in range(self.shards)}
        for s, k in enumerate(self.owner):
            owned[k].append(s)
        heap = [(-len(v), k) for k, v in owned.items()]
        heapq.heapify(heap)
        owner = list(self.owner)
        for _ in range(len(owner) // (self.shards + 1)):
            n, k = heapq.heappop(heap)
            owner[owned[k].pop()] = self.shards
            heapq.heappush(heap, (n + 1, k))
        return SlotMap(self.version + 1, self.shards + 1, tuple(owner))

    def rebalance(self, slot_bytes: dict[int, int], tolerance: float = 0.02) -> SlotMap:
        """Move slots from the fullest to the emptiest shard while that narrows the gap and a shard is over the mean by tolerance.

        slot_bytes comes from slot_stats(); slots that it lacks have no bytes. Ties go to the lower slot.
        """
        owner, load = list(self.owner), [0] * self.shards
        held: list[list[tuple[int, int]]] = [[] for _ in range(self.shards)]
        for s, k in enumerate(owner):
            load[k] += slot_bytes.get(s, 0)
            if slot_bytes.get(s, 0):
                held[k].append((slot_bytes[s], s))
        for own in held:
            own.sort()
        mean = sum(load) / self.shards
        for _ in range(4 * len(owner)):
            full, empty = max(range(self.shards), key=lambda k: (load[k], -k)), min(range(self.shards), key=lambda k: (load[k], k))
            gap, own = load[full] - load[empty], held[full]
            if load[full] <= mean * (1 + tolerance):
                break
            # A shard's slots are kept by size, so the one next to half the gap is found by bisection.
            at = bisect.bisect_left(own, (gap / 2, -1))
            below = bisect.bisect_left(own, (own[at - 1][0], -1)) if at else 0
            near = [own[k] for k in {at, below} if k < len(own) and own[k][0] < gap]
            if not near:
                break
            size, s = min(near, key=lambda x: (abs(gap / 2 - x[0]), x[1]))
            own.remove((size, s))
            bisect.insort(held[empty], (size, s))
            owner[s] = empty
            load[full] -= size
            load[empty] += size
        return SlotMap(self.version + 1, self.shards, tuple(owner))

    def frame(self, spark: SparkSession) -> DataFrame:
        """version, virtual_slot, shard: one row a slot, at most MAX_SLOTS."""
        owners = F.split(F.lit(",".join(map(str, self.owner))), ",")
        return spark.range(1).select(F.lit(self.version).alias("version"), F.posexplode(owners).alias("virtual_slot", "s")).select("version", "virtual_slot", F.col("s").cast("int").alias("shard"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Append this version to the map's table."""
        self.frame(spark).coalesce(1).write.mode("append").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, by default the latest."""
        rows = spark.read.parquet(path)
        if version is None:
            version = rows.agg(F.max("version")).first()[0]
        got = rows.where(F.col("version") == version).orderBy("virtual_slot").limit(MAX_SLOTS).collect()
        if not got:
            raise ValueError(f"no version {version} in {path}")
        return SlotMap(version, max(r["shard"] for r in got) + 1, tuple(r["shard"] for r in got))


def with_slot(docs: DataFrame, key: str = "doc_id", slots: int = SLOTS, out: str = "virtual_slot") -> DataFrame:
    """Add the virtual slot of each row."""
    return docs.withColumn(out, F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int"))


def record_size(text: str = "text"):
    """UTF-8 bytes of the text, none for null, and a fixed overhead."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("long")


def slot_stats(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """virtual_slot, slot_rows, slot_bytes: at most one row a slot, summed before the shuffle."""
    sized = docs.select(F.col(key).alias("key"), record_size(text).alias("size"))
    return with_slot(sized, "key", slots).groupBy("virtual_slot").agg(F.count("*").alias("slot_rows"), F.sum("size").alias("slot_bytes"))


def rebalanced(docs: DataFrame, slot_map: SlotMap, key: str = "doc_id", text: str = "text", tolerance: float = 0.02) -> SlotMap:
    """The next version of the map, edited for the bytes that its slots hold now. Brings one row a slot to the driver."""
    stats = slot_stats(docs, key, text, len(slot_map.owner)).collect()
    return slot_map.rebalance({r["virtual_slot"]: r["slot_bytes"] for r in stats}, tolerance)


def _checksum(text: str = "text"):
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def _offsets(docs: DataFrame, slot_map: SlotMap, key: str, text: str) -> DataFrame:
    """virtual_slot, part, shard, version, slot_bytes, before (the shard's rows in earlier parts): PARTS rows a slot at most."""
    sized = docs.select(F.col(key).alias("key"), record_size(text).alias("size"), F.pmod(_checksum(text), F.lit(PARTS)).alias("part"))
    stats = with_slot(sized, "key", len(slot_map.owner)).groupBy("virtual_slot", "part").agg(F.count("*").alias("part_rows"), F.sum("size").alias("part_bytes"))
    earlier = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = stats.join(F.broadcast(slot_map.frame(docs.sparkSession)), "virtual_slot")
    return placed.select("virtual_slot", "part", "shard", "version", F.sum("part_bytes").over(Window.partitionBy("shard", "virtual_slot")).alias("slot_bytes"), F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("before"))


def assign(docs: DataFrame, slot_map: SlotMap, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard, slot (place in the shard, gapless from 0), slot_bytes, map_version."""
    rows = docs.select(F.col(key).alias("doc_id"), record_size(text).alias("size"), _checksum(text).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    counted = with_slot(counted, "doc_id", len(slot_map.owner)).withColumn("part", F.pmod("text_crc32", F.lit(PARTS)))
    earlier = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        counted.withColumn("place", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
        .join(F.broadcast(_offsets(docs, slot_map, key, text)), ["virtual_slot", "part"])
        .select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("before") + F.col("place")).alias("first"), "copies", "slot_bytes", F.col("version").alias("map_version"))
    )
    few = placed.where(F.col("copies") <= CHUNK).select("*", F.lit(0).cast("long").alias("chunk"))
    # More copies than a chunk holds are dealt out in chunks before they become rows.
    many = placed.where(F.col("copies") > CHUNK).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK))).alias("chunk")).repartition("doc_id", "text_crc32", "size", "chunk")

    def dealt(of: DataFrame) -> DataFrame:
        low = F.col("chunk") * CHUNK
        one = F.explode(F.sequence(low, F.least(low + CHUNK, "copies") - 1)).alias("copy")
        return of.select("*", one).select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("first") + F.col("copy")).cast("long").alias("slot"), "slot_bytes", "map_version")

    return dealt(few).union(dealt(many))


def op1_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards under the law `key`; grown_shard is the owner of the row's slot in the next version of the map."""
    now = SlotMap.of(SHARDS)
    placed = assign(table(spark, sf_dir, "documents"), now)
    grown = now.grow().frame(spark).select("virtual_slot", F.col("shard").alias("grown_shard"))
    return placed.join(F.broadcast(grown), "virtual_slot").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "virtual_slot", "slot_bytes", "map_version")
