import zlib

import pytest
from pyspark.sql import functions as F

from stratus.llm.sharding import SlotMap, assign, rebalanced, slot_stats

DOCS = "doc_id bigint, text string"


def docs(spark, n=500):
    return spark.createDataFrame([(i, "x" * (i % 37) + "é") for i in range(n)], DOCS)


def test_growth_moves_rows_only_into_the_new_shard():
    m = SlotMap.of(24)
    g = m.grow()
    moved = [(a, b) for a, b in zip(m.owner, g.owner, strict=True) if a != b]
    assert moved and {b for _, b in moved} == {24} and g.version == m.version + 1
    counts = [m.owner.count(k) for k in range(24)]
    assert max(counts) - min(counts) <= 1
    assert SlotMap.of(24).grow() == SlotMap.of(25)


def test_bounds():
    with pytest.raises(ValueError):
        SlotMap.of(0)
    with pytest.raises(ValueError):
        SlotMap.of(4, 4).grow()


def test_assignment_against_brute_force(spark):
    rows = assign(docs(spark), SlotMap.of(5, 64)).collect()
    assert len(rows) == 500
    for k in range(5):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    text = {r.doc_id: r.text for r in docs(spark).collect()}
    owner = SlotMap.of(5, 64).owner
    totals = {}
    for r in rows:
        assert r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        assert r.shard == owner[r.virtual_slot]
        totals[r.virtual_slot] = totals.get(r.virtual_slot, 0) + r.size
    assert all(r.slot_bytes == totals[r.virtual_slot] for r in rows)


def test_a_key_of_many_rows(spark):
    df = docs(spark).withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(7)).otherwise(F.col("doc_id")))
    got = assign(df, SlotMap.of(3, 16)).collect()
    assert len(got) == 500 and len({r.shard for r in got if r.doc_id == 7}) == 1
    for k in range(3):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))


def test_the_shard_depends_on_the_key_alone(spark):
    m = SlotMap.of(24)
    every = {r.doc_id: r.shard for r in assign(docs(spark), m).collect()}
    some = {r.doc_id: r.shard for r in assign(docs(spark).where("doc_id % 3 = 0").withColumn("text", F.lit("other")), m).collect()}
    assert all(every[k] == v for k, v in some.items())


def test_rebalancing_evens_out_bytes(spark):
    m = SlotMap.of(4, 256)
    heavy = docs(spark).withColumn("text", F.when(F.col("doc_id") % 50 == 0, F.repeat(F.lit("y"), 2000)).otherwise(F.col("text")))
    after = rebalanced(heavy, m)

    def spread(x):
        load = [0] * 4
        for r in slot_stats(heavy, slots=256).collect():
            load[x.owner[r.virtual_slot]] += r.slot_bytes
        return max(load) - min(load)

    assert after.version == m.version + 1 and spread(after) < spread(m) / 2


def test_stored_versions(spark, tmp_path):
    m = SlotMap.of(3, 16)
    m.save(spark, str(tmp_path / "map"))
    m.grow().save(spark, str(tmp_path / "map"))
    assert SlotMap.load(spark, str(tmp_path / "map")) == m.grow()
    assert SlotMap.load(spark, str(tmp_path / "map"), m.version) == m
    with pytest.raises(ValueError):
        SlotMap.load(spark, str(tmp_path / "map"), 99)


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    rows = [(None, None), (None, None), (1, ""), (1, ""), (2, "a")]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in ("shard", "slot", "size", "virtual_slot", "key", "place", "version")})
    got = assign(df, SlotMap.of(2, 8)).collect()
    assert len(got) == 5 and sorted(r["size"] for r in got) == [8, 8, 8, 8, 9]
    for k in range(2):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    assert assign(spark.createDataFrame([], DOCS), SlotMap.of(2, 8)).count() == 0


def test_rows_repeated_more_than_a_chunk(spark, monkeypatch):
    from stratus.llm import sharding

    monkeypatch.setattr(sharding, "CHUNK", 7)
    df = spark.range(100).select(F.when(F.col("id") < 60, 1).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text")).repartition(5)
    got = assign(df.union(df.where("doc_id = 1").select(F.lit(None).cast("long"), F.lit(None).cast("string"))), SlotMap.of(3)).toPandas()
    assert len(got) == 160 and (got.groupby("doc_id", dropna=False).size().max(), got.doc_id.isna().sum()) == (60, 60)
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_moves_against_a_search_of_all_slots():
    import random

    def slow(m, slot_bytes, tolerance=0.02):
        owner, load = list(m.owner), [0] * m.shards
        for s, k in enumerate(owner):
            load[k] += slot_bytes.get(s, 0)
        mean = sum(load) / m.shards
        for _ in range(4 * len(owner)):
            full, empty = max(range(m.shards), key=lambda k: (load[k], -k)), min(range(m.shards), key=lambda k: (load[k], k))
            gap = load[full] - load[empty]
            fits = [(abs(gap / 2 - slot_bytes.get(s, 0)), s) for s, k in enumerate(owner) if k == full and 0 < slot_bytes.get(s, 0) < gap]
            if load[full] <= mean * (1 + tolerance) or not fits:
                break
            s = min(fits)[1]
            owner[s] = empty
            load[full] -= slot_bytes[s]
            load[empty] += slot_bytes[s]
        return tuple(owner)

    r = random.Random(6)
    for _ in range(60):
        m = SlotMap.of(r.randint(1, 6), 60)
        sizes = {s: r.choice((0, 1, 5, 5, 9, r.randint(0, 500))) for s in range(60) if r.random() < 0.9}
        assert m.rebalance(sizes).owner == slow(m, sizes)
