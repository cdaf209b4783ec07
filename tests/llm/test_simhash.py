import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from stratus.llm.simhash import components, drop_near_duplicates, fingerprint, links, near_duplicates

DOCS = "doc_id bigint, text string"


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two", "A b C", "a b c d e f g " * 40, "É È x y z", "same same same same", "x\x0by\x0cz w"])
def test_fingerprints(text):
    assert fingerprint(text) == slow_fingerprint(text)


def brute_components(fps):
    keys, parent = list(fps), {k: k for k in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_linked_fingerprints_against_brute_force(spark):
    r = random.Random(3)
    values, base = [], [r.getrandbits(64) for _ in range(12)]
    for v in base:
        chain = v
        for _ in range(12):
            chain ^= 1 << r.randrange(64)
            if r.random() < 0.5:
                chain ^= 1 << r.randrange(64)
            if r.random() < 0.2:
                chain ^= 7 << r.randrange(60)
            values.append(chain)
    values = sorted(set(values + base + [0, 1, 1 << 63, (1 << 63) | 3]))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {r.node: r.root for r in components(links(spark.createDataFrame([(v,) for v in signed], "fp bigint"))).collect()}
    want = brute_components(dict(zip(signed, values, strict=True)))
    assert all(got.get(k, k) == v for k, v in want.items())


def test_components_of_long_chains(spark):
    ids = list(range(200))
    random.Random(1).shuffle(ids)
    edges = spark.createDataFrame([(a, b) for a, b in zip(ids, ids[1:], strict=False)], "a bigint, b bigint")
    for part_edges in (10, 60, 10_000):
        assert {r.root for r in components(edges, part_edges=part_edges).collect()} == {0}
    two = spark.createDataFrame([(5, 9), (9, 7), (1, 2), (2, 1), (3, 3)], "a bigint, b bigint")
    assert sorted((r.node, r.root) for r in components(two, part_edges=1).collect()) == [(1, 1), (2, 1), (5, 5), (7, 5), (9, 5)]
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents_against_brute_force(spark):
    r = random.Random(5)
    words = ["w%d" % i for i in range(400)]
    rows = []
    for k in range(30):
        body = [r.choice(words) for _ in range(r.choice((1, 2, 3, 60, 900)))]
        rows.append((k * 10, " ".join(body)))
        rows.append((k * 10 + 1, " ".join(body).upper()))
        for j in range(2, 5):
            near = list(body)
            near[r.randrange(len(near))] = r.choice(words)
            rows.append((k * 10 + j, "  ".join(near)))
    rows += [(1001, None), (1002, ""), (1003, "   ")]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in ("fp", "component_id", "fingerprint", "root")})
    got = {x.doc_id: (x.fingerprint, x.component_id) for x in near_duplicates(df).collect()}
    fps = {d: slow_fingerprint(t) for d, t in rows}
    want = brute_components(fps)
    assert got == {d: (f"{fps[d]:016x}", want[d]) for d, _ in rows}
    assert got[1002][1] == 1001
    kept = {x.doc_id for x in drop_near_duplicates(df).collect()}
    assert kept == {d for d in fps if want[d] == d}
    assert drop_near_duplicates(df).columns == df.columns


def test_repeats_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "q")], DOCS)
    got = sorted(((x.doc_id or 0, x.component_id) for x in near_duplicates(df).collect()), key=str)
    assert got == [(0, 7), (0, None), (7, 7), (7, 7)]
    kept = drop_near_duplicates(df).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "q"), (7, "a b c d")]
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def close_group(r, n, bits=64, flips=3):
    """Distinct values near one centre, and some far ones."""
    centre = r.getrandbits(64)
    out = {centre}
    while len(out) < n:
        v = centre
        for _ in range(r.randint(1, flips)):
            v ^= 1 << r.randrange(bits)
        out.add(v)
    return out | {r.getrandbits(64) for _ in range(n // 4)}


@pytest.mark.parametrize("segments, distance, hot", [(2, 2, 64), (2, 2, 1), (2, 2, 5), (3, 2, 3), (4, 2, 64), (2, 1, 2), (2, 0, 1)])
def test_links_connect_the_same_by_any_index(spark, segments, distance, hot):
    r = random.Random(segments * 10 + distance)
    values = sorted(close_group(r, 120) | close_group(r, 60, 32, 2) | close_group(r, 40, 64, 6))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = [(x.a, x.b) for x in links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), segments, distance, hot).collect()]
    mask = (1 << 64) - 1
    assert all(a < b and ((a ^ b) & mask).bit_count() <= distance for a, b in found) and len(found) == len(set(found))
    parent = {v: v for v in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    slow = {v: v for v in signed}

    def root(x):
        while slow[x] != x:
            x = slow[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[i + 1 :]:
            if ((a ^ b) & mask).bit_count() <= distance:
                x, y = root(a), root(b)
                slow[max(x, y)] = min(x, y)
    assert {v: find(v) for v in signed} == {v: root(v) for v in signed}


def test_the_number_of_segments_changes_the_table_and_candidates_are_rejected(spark):
    from stratus.llm.simhash import ball_entries, table_entries

    r = random.Random(8)
    classes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in close_group(r, 80, 32, 8)], "fp bigint")
    n = classes.count()
    for segments, ball in ((2, 33), (3, 1), (4, 1)):
        assert table_entries(classes, segments).count() == segments * n
        assert ball_entries(classes, segments, 2, upward=False).count() == segments * ball * n
    asked, table = ball_entries(classes).select("key", F.col("fp").alias("a")), table_entries(classes).select("key", F.col("fp").alias("b"))
    fetched = asked.join(table, "key").where("a <> b").select("a", "b").distinct()
    near = fetched.where("bit_count(a ^ b) <= 2").count()
    assert 0 < near < fetched.count()


def test_long_texts_and_hubs(spark):
    long = " ".join(f"w{i % 977}" for i in range(150_000))
    assert fingerprint(long) == slow_fingerprint(long)
    edges = spark.range(3000).select(F.lit(0).cast("long").alias("a"), (F.col("id") + 1).alias("b")).union(spark.range(2000).select((F.col("id") + 5000).alias("a"), (F.col("id") + 5001).alias("b")))
    got = components(edges, part_edges=500).groupBy("root").count().collect()
    assert sorted((x.root, x["count"]) for x in got) == [(0, 3001), (5000, 2001)]
