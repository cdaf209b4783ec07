"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import negatives
from stratus.llm.negatives import bounds, cells_of, hard_negatives, may_enter

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=100):
    kept = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            kept[i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = None
    kept = list(kept)
    out = []
    for a in (r for r in kept if r[0] % every == 0):
        scored = [(sum(x * y for x, y in zip(a[2], b[2], strict=False)), b) for b in kept if b is not a]
        first = lambda of: sorted(of, key=lambda s: (-s[0], *s[1]))
        for ps, p in first(s for s in scored if s[1][1] == a[1])[:5]:
            inside = first(s for s in scored if s[1][1] != a[1] and 30 * ps <= 100 * s[0] <= 90 * ps)[:10]
            out += [(a[0], p[0], k + 1, n[0], ps, ns) for k, (ns, n) in enumerate(inside)]
    return sorted(out)


def vectors(n, d, seed, copies=0, labels=10):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(labels, d))
    rows = []
    for i in range(n):
        label = int(r.integers(labels))
        v = middles[label] * r.uniform(0, 1) + r.normal(size=d)
        rows.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), label))
    hot = rows[0][1]
    return [(i, hot if i < copies else v, 1 if i < copies else label) for i, v, label in rows]


def got(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema)
    return sorted(tuple(r[n] for n in NAMES) for r in hard_negatives(df, **more).collect())


@pytest.mark.parametrize("n, d, copies", [(700, 24, 0), (600, 8, 260), (350, 2, 0)])
def test_against_all_pairs(spark, monkeypatch, n, d, copies):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 97)
    rows = vectors(n, d, seed=n, copies=copies)
    assert got(spark, rows, every=25) == brute(rows, 25)


def test_several_blocks_of_anchors(spark, monkeypatch):
    rows = vectors(400, 12, seed=5)
    monkeypatch.setattr(negatives, "ANCHORS_A_BLOCK", 7)
    few = got(spark, rows, every=10)
    monkeypatch.setattr(negatives, "BROADCAST_BYTES", 0)
    assert few == got(spark, rows, every=10) == brute(rows, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.9, 0.5], 1), (1, [1.0], 1), (2, [0.5, 0.25, 7.0], 2), (3, [], 2), (4, None, 1), (5, [1.0, nan], 1), (6, [inf, 1.0], 2), (7, [None, 1.0], 2)]
    rows += [(8, [0.5, 0.5], None), (None, [0.5, 0.5], 1), (9, [0.4, 0.3], 2), (10, [0.4, 0.3], 2), (11, [0.4, 0.3], 3), (100, [-1.0, 0.2], 2), (200, [0.0, 0.0], 3), (300, [0.3, 0.3], 9)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 1)]) == [] and got(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == [(0, 1, 1, 2, 0, 0)]


def test_other_columns_may_have_the_operators_names(spark):
    rows = vectors(200, 6, seed=8)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in ("id", "v", "part", "block", "rank", "anchor_id", "key")])
    assert sorted(tuple(r[n] for n in NAMES) for r in hard_negatives(df, every=50).collect()) == brute(rows, 50)


def test_bounds_hold_every_score_and_spare_most(spark):
    r = np.random.default_rng(2)
    x, a = r.integers(-120, 121, size=(3000, 32)), r.integers(-120, 121, size=(5, 32))
    x[:900, 3] = 17
    codes, lows, highs = cells_of(x)
    least, largest = bounds(a, codes, lows, highs)
    scores = x @ a.T
    assert (least <= scores).all() and (scores <= largest).all() and (codes < negatives.CELLS).all()
    for k in range(5):
        picked = may_enter(least[:, k], largest[:, k], -np.inf, np.inf, 6)
        assert set(np.argsort(-scores[:, k], kind="stable")[:6]) <= set(picked) and len(picked) < 300


def test_the_query_agrees_with_its_sql(spark):
    import duckdb

    from stratus.llm.queries import oracle_sql

    con = duckdb.connect()
    con.sql("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    want = con.sql(oracle_sql()["op13_approximation_file_negatives"]).fetchall()
    rows = negatives.op13_approximation_file_negatives(spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in rows) == sorted(want) and len(rows) > 100


def test_random_small_tables(spark):
    r = random.Random(4)
    rows = [(r.randrange(120), [r.choice((-0.5, 0.0, 0.25, 0.5)) for _ in range(3)], r.randrange(3)) for _ in range(150)]
    assert got(spark, rows, every=5) == brute(rows, 5)
