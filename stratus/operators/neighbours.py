"""Counties that share an edge, and local spatial correlation (Moran's I)."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.operators.spatial import _edges

PERMUTATIONS = 99
SEED = 42
#: Values stand in blocks of so many, counties draw in lots of so many and so many permutations: places in either fit 16 bits.
BLOCK = 1 << 15
LOT = 661
SPAN = 99
ROW_DRAWS = 4096


def contiguity(counties: DataFrame, digits: int = 6) -> DataFrame:
    """geoid, neighbour: both ways, each pair once, of counties with an edge in common whose ends agree to so many digits.

    Edges meet by their ends, lesser one first, so there is one shuffle of edges; an edge has two sides, and what more there are (overlapping
    shapes) is compared within the edge. Counties that touch in points, or along parts of edges with other ends, are no neighbours.
    """
    point = lambda p: F.struct(F.round(p["lon"], digits).alias("x"), F.round(p["lat"], digits).alias("y"))
    ends = F.transform(F.flatten(F.transform("rings", _edges)), lambda e: F.struct(F.least(point(e["a"]), point(e["b"])).alias("p"), F.greatest(point(e["a"]), point(e["b"])).alias("q")))
    edges = counties.select("geoid", F.inline(ends)).where("p <> q")
    sides = edges.groupBy("p", "q").agg(F.collect_set("geoid").alias("g")).where(F.size("g") > 1).select("g")
    return sides.select(F.explode("g").alias("geoid"), "g").select("geoid", F.explode("g").alias("neighbour")).where("geoid <> neighbour").distinct()


def local_moran(values: DataFrame, pairs: DataFrame, permutations: int = 0, seed: int = SEED) -> DataFrame:
    """geoid, z, lag, moran, quadrant (high-high, low-low, high-low, low-high; none without neighbours), neighbours and, with permutations, p.

    values: geoid, value, one row a county; counties without a value take no part. z is the deviation from the mean in population standard
    deviations, lag the neighbours' mean z, moran their product: the local statistic under row-standardised weights, whose mean is the global one.
    A county without neighbours has none, and where all values are alike z is null.

    p is the pseudo-p of as many conditional permutations: neighbours' values are drawn, with replacement, from the other counties, by hashes of
    seed, county, permutation and place, so a seed always gives the same p. Draws meet values by a number of each county, links times
    permutations of them. They travel packed, those of a lot of counties to a block of values as one row: four bytes a draw there, ten back.
    A lot's draws are summed in one group, of at most LOT rows of ROW_DRAWS draws (one permutation, where a county has more neighbours).
    """
    held = values.where(F.col("value").isNotNull()).select("geoid", F.col("value").cast("double").alias("value"))
    s = held.agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("dev"), F.count("*").alias("n"))
    stats = s.select(F.struct("mean", "dev", "n")).scalar()
    scored = held.select("geoid", ((F.col("value") - stats["mean"]) / F.nullif(stats["dev"], F.lit(0.0))).alias("z"))
    near = pairs.join(scored.select(F.col("geoid").alias("neighbour"), F.col("z").alias("near")), "neighbour").groupBy("geoid").agg(F.avg("near").alias("lag"), F.count("*").alias("neighbours"))
    out = scored.join(near, "geoid", "left").select("geoid", "z", "lag", (F.col("z") * F.col("lag")).alias("moran"), F.coalesce("neighbours", F.lit(0)).alias("neighbours"))
    side = lambda c: F.when(F.col(c) > 0, "high").otherwise("low")
    out = out.withColumn("quadrant", F.when(F.col("moran").isNull(), "none").otherwise(F.concat_ws("-", side("z"), side("lag"))))
    return _with_p(out, scored, permutations, seed) if permutations else out


def numbered(scored: DataFrame, seed: int = SEED) -> DataFrame:
    """All columns and number, 0 to n - 1, by a hash of geoid: in buckets as many as the root of n, whose sizes are summed first. Counts the rows."""
    buckets = max(1, isqrt(scored.count()))
    hashed = F.xxhash64("geoid", F.lit(seed))
    placed = scored.withColumn("__bucket", F.pmod(hashed, F.lit(buckets)))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row a bucket in one task.
    starts = placed.groupBy("__bucket").agg(F.count("*").alias("__n")).select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy("__bucket").orderBy(hashed, "geoid")) - 1
    return placed.withColumn("__own", own).join(starts, "__bucket").withColumn("number", F.col("__start") + F.col("__own")).drop("__bucket", "__own", "__start")


def _with_p(out: DataFrame, scored: DataFrame, permutations: int, seed: int) -> DataFrame:
    known = numbered(scored, seed).select("geoid", "z", "number")
    others, tasks = max(1, scored.count() - 1), int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = F.least(F.lit(SPAN), F.greatest(F.lit(1), F.floor(ROW_DRAWS / F.col("neighbours")))).cast("int")
    asking = out.where("neighbours > 0 and moran is not null").join(known.drop("z"), "geoid").select("geoid", "number", "z", "moran", "neighbours", F.explode(F.sequence(F.lit(1), F.lit(permutations), span)).alias("first"), span.alias("span"))
    asking = asking.select(F.floor(F.col("number") / LOT).alias("lot"), "first", "geoid", "number", "z", "moran", "neighbours", F.least(F.col("first") + F.col("span") - 1, F.lit(permutations)).alias("last"))
    # Dealt and sorted before anything is drawn, so that counties are shuffled and not their draws.
    dealt = asking.select("lot", "first", "geoid", "number", "neighbours", "last").repartition(tasks, "lot", "first").sortWithinPartitions("lot", "first", "number")
    hashes = F.transform(F.sequence("first", "last"), lambda p: F.transform(F.sequence(F.lit(1).cast("bigint"), "neighbours"), lambda place: F.xxhash64(F.lit(seed), "geoid", p, place)))
    drawn = dealt.select("lot", "first", "number", "neighbours", F.flatten(hashes).alias("hashes")).mapInArrow(_packed(others), "lot bigint, first int, block bigint, slots binary, offsets binary")
    values = known.select(F.floor(F.col("number") / BLOCK).alias("block"), (F.col("number") % BLOCK).cast("int").alias("at"), "z")
    # Of a block the values first, then what is drawn from them.
    both = values.unionByName(drawn.withColumn("at", F.lit(BLOCK)), allowMissingColumns=True).repartition(tasks, "block").sortWithinPartitions("block", "at")
    found = both.select("block", "at", "z", "lot", "first", "slots", "offsets").mapInArrow(_looked_up(), "lot bigint, first int, block bigint, slots binary, found binary")
    counts = asking.select("lot", "first", "geoid", "number", "z", "moran", "neighbours", "last").groupBy("lot", "first").cogroup(found.groupBy("lot", "first")).applyInArrow(_beyond(), "geoid string, above bigint, below bigint")
    # As many draws on the side of the statistic, whichever side that is.
    beyond = counts.groupBy("geoid").agg(F.sum("above").alias("above"), F.sum("below").alias("below"))
    p = beyond.select("geoid", ((F.least("above", "below") + 1) / F.lit(permutations + 1)).alias("p"))
    return out.join(p, "geoid", "left")


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """values cut at bounds, each piece a binary."""
    ends = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _packed(others: int):
    """lot, first, block, slots (16 bits: county in the lot and permutation), offsets (16 bits: value in the block) of counties' hashes, a row for each lot and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lots, firsts, numbers, near = (batch.column(k).to_numpy() for k in range(4))
            starts = np.flatnonzero(np.r_[True, (np.diff(lots) != 0) | (np.diff(firsts) != 0)]).tolist() if len(lots) else []
            for a, b in zip(starts, [*starts[1:], len(lots)], strict=True):
                lists = batch.column(4).slice(a, b - a)
                drawn = np.mod(lists.flatten().to_numpy(), others)
                degree = near[a:b]
                made = np.diff(lists.offsets.to_numpy()) // degree
                row = np.repeat(np.arange(b - a), made)
                permutation = np.arange(len(row)) - np.repeat(np.cumsum(made) - made, made)
                slots = np.repeat(((numbers[a:b] % LOT)[row] * SPAN + permutation).astype(np.uint16), degree[row])
                # Of the others: numbers from the county's own on are moved up by one.
                drawn += drawn >= np.repeat(numbers[a:b], made * degree)
                block = drawn // BLOCK
                order = np.argsort(block.astype(np.uint16) if others < BLOCK << 16 else block, kind="stable")
                block, bounds = np.unique(block[order], return_index=True)
                bounds = np.append(bounds, len(order))
                n = len(block)
                columns = [np.full(n, lots[a]), np.full(n, firsts[a], np.int32), block]
                yield pa.record_batch([*map(pa.array, columns), _binaries(slots[order], bounds), _binaries((drawn % BLOCK).astype(np.uint16)[order], bounds)], names=["lot", "first", "block", "slots", "offsets"])

    return run


def _looked_up():
    """The draws (lot, first, block, slots) with the values found for them; of each block the values come before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, np.zeros(BLOCK)
        for batch in batches:
            blocks, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.flatnonzero(np.r_[True, (np.diff(blocks) != 0) | (np.diff(at == BLOCK) != 0)]).tolist() if len(blocks) else []
            for a, b in zip(starts, [*starts[1:], len(blocks)], strict=True):
                part = batch.slice(a, b - a)
                if blocks[a] != now:
                    now, held = blocks[a], np.full(BLOCK, np.nan)
                if at[a] < BLOCK:
                    held[at[a:b]] = part.column(2).to_numpy(zero_copy_only=False)
                    continue
                offsets = part.column(6)
                sizes = np.frombuffer(offsets.buffers()[1], np.int32)[offsets.offset : offsets.offset + b - a + 1] // 2
                drawn = np.frombuffer(offsets.buffers()[2], np.uint16)[sizes[0] : sizes[-1]]
                yield pa.record_batch([part.column(3), part.column(4), part.column(0), part.column(5), _binaries(held[drawn], sizes - sizes[0])], names=["lot", "first", "block", "slots", "found"])

    return run


def _beyond():
    """geoid, above, below: of a lot's counties the permutations whose statistic is at least, and at most, their own."""

    def run(counties: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by("block")
        slots, values = (np.concatenate([np.frombuffer(x, kind) for x in found[c].to_pylist()]) for c, kind in (("slots", np.uint16), ("found", np.float64)))
        sums = np.bincount(slots, values, LOT * SPAN).reshape(LOT, SPAN)
        number, z, moran, near, first, last = (counties[c].to_numpy() for c in ("number", "z", "moran", "neighbours", "first", "last"))
        made = z[:, None] * (sums[number % LOT] / near[:, None])
        counted = np.arange(SPAN) <= (last - first)[:, None]
        above, below = ((x & counted).sum(axis=1) for x in (made >= moran[:, None], made <= moran[:, None]))
        return pa.table({"geoid": counties["geoid"], "above": pa.array(above, pa.int64()), "below": pa.array(below, pa.int64())})

    return run
