"""Spells, drought index, neighbours and local Moran against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_areas import tiling
from test_operators import shapes

from stratus.operators import neighbours, spells

ROWS = "cell string, year int, doy int, v double"


def test_spells_run_on_into_the_next_year(spark):
    days = [("a", 1999, d, 1.0) for d in (1, 2, 3, 10, 363, 364, 365)] + [("a", 2000, d, 1.0) for d in (1, 2, 366)] + [("a", 2001, 1, 1.0)]
    days += [("a", 1999, 2, 0.0), ("a", 1999, 10, 1.0), ("a", 1999, 11, None), ("a", 2000, 3, 0.0), ("b", 1999, 5, 0.0), ("c", None, 5, 1.0)]
    df = spark.createDataFrame(days, ROWS)
    found = spells.spells(df, F.col("v") > 0, ("cell",))
    assert sorted((r.cell, r.first, r.days) for r in found.collect()) == [("a", 1999 * 365, 3), ("a", 1999 * 365 + 9, 1), ("a", 1999 * 365 + 362, 5), ("a", 2000 * 365 + 364, 2)]
    by = spells.spells_by_year(spells.spells(df, F.col("v") > 0, ("cell",), at_least=2), ("cell",))
    assert sorted(tuple(r) for r in by.collect()) == [("a", 1999, 2, 8, 5), ("a", 2000, 1, 2, 2)]
    assert spells.spells(df.limit(0), F.col("v") > 0, ("cell",)).count() == 0


def test_spells_take_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("cell"), F.lit(2000).alias("year"), F.col("id").alias("doy"), F.lit(1.0).alias("v"))
    plan = spells.spells(df, F.col("v") > 0, ("cell",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def plain_gamma_share(a, x):
    """By integrating the density over its logarithm."""
    if x <= 0:
        return 0.0
    t = np.linspace(math.log(x) - max(60.0, 60.0 / a), math.log(x), 400_001)
    f = np.exp(a * t - np.exp(t) - math.lgamma(a))
    return float(((f[1:] + f[:-1]) / 2).sum() * (t[1] - t[0]))


@pytest.mark.parametrize("a", [0.3, 1.0, 2.7, 15.0, 120.0])
def test_gamma_shares(a):
    x = np.array([0.0, 0.01 * a, 0.5 * a, a, a + 1, 1.5 * a, 3 * a + 5])
    got = spells.gamma_share(np.full(len(x), a), x)
    assert got.tolist() == pytest.approx([plain_gamma_share(a, v) for v in x], abs=1e-8)
    if a == 1.0:
        assert got.tolist() == pytest.approx((1 - np.exp(-x)).tolist(), abs=1e-14)


def test_normal_scores():
    from statistics import NormalDist

    p = np.array([1e-12, 0.001, 0.3, 0.5, 0.8, 0.999999, 0.0, 1.0, np.nan])
    got = spells.normal_score(p)
    assert got[:6].tolist() == pytest.approx([NormalDist().inv_cdf(v) for v in p[:6]], abs=1e-8) and got[6] == -math.inf and got[7] == math.inf and math.isnan(got[8])
    assert len(spells.normal_score(np.zeros(0))) == 0


def test_drought_index_against_a_plain_version(spark):
    from statistics import NormalDist

    r = random.Random(8)
    rows = [(c, y, m, 0.0 if r.random() < 0.2 else r.gammavariate(2.0, 30.0)) for c in ("x", "y") for y in range(1980, 2010) for m in range(1, 13)]
    rows += [("few", y, 1, 5.0 + y % 2) for y in (2000, 2001)] + [("same", y, 1, 7.0) for y in range(2000, 2010)] + [("dry", y, 1, 0.0) for y in range(2000, 2010)]
    df = spark.createDataFrame(rows, "cell string, year int, month int, total double")
    got = {(x.cell, x.year, x.month): x["index"] for x in spells.drought_index(df, ("cell",)).collect()}
    assert len(got) == len(rows)
    for c in ("x", "y"):
        for m in (1, 7):
            totals = [(y, t) for k, y, n, t in rows if k == c and n == m]
            wet = [t for _, t in totals if t > 0]
            q = 1 - len(wet) / len(totals)
            a = math.log(sum(wet) / len(wet)) - sum(map(math.log, wet)) / len(wet)
            shape = (1 + math.sqrt(1 + 4 * a / 3)) / (4 * a)
            for y, t in totals:
                p = q + (1 - q) * (plain_gamma_share(shape, t / (sum(wet) / len(wet) / shape)) if t > 0 else 0.0)
                assert got[c, y, m] == pytest.approx(max(-3.09, min(3.09, NormalDist().inv_cdf(p))), abs=1e-6)
    assert {v for k, v in got.items() if k[0] in ("few", "same", "dry")} == {None}
    scores = [v for k, v in got.items() if k[0] == "x"]
    assert abs(sum(scores) / len(scores)) < 0.3


def test_totals_over_several_months(spark):
    rows = [("a", 1999, 11, 1.0), ("a", 1999, 12, 2.0), ("a", 2000, 1, 4.0), ("a", 2000, 3, 8.0), ("a", 2000, 4, 16.0), ("a", 2000, 5, 32.0)]
    df = spark.createDataFrame(rows, "cell string, year int, month int, total double")
    assert sorted(tuple(r) for r in spells.accumulated(df, ("cell",), 3).collect()) == [("a", 2000, 1, 7.0), ("a", 2000, 5, 56.0)]
    months = spark.range(1, 367).select(spells.month_of(F.col("id")).alias("m")).groupBy("m").count().collect()
    assert {r.m: r["count"] for r in months} == dict(zip(range(1, 13), (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 32), strict=True))


def test_neighbours_of_a_tiling(spark):
    pairs = {(r.geoid, r.neighbour) for r in neighbours.contiguity(shapes(spark, **tiling())).collect()}
    grid = {(f"{i}{j}", f"{i + a}{j + b}") for i in range(4) for j in range(3) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1)) if 0 <= i + a < 4 and 0 <= j + b < 3}
    assert pairs == grid | {("11", "99"), ("99", "11")}


def test_local_moran_and_its_significance(spark):
    side = 12
    r = random.Random(3)
    ring = lambda i, j: [[(float(i), float(j)), (i + 1.0, float(j)), (i + 1.0, j + 1.0), (float(i), j + 1.0)]]
    counties = shapes(spark, **{f"{i}:{j}": ring(i, j) for i in range(side) for j in range(side)}, alone=ring(50, 50), unknown=ring(51, 50))
    value = {(i, j): (10.0 if i < 4 and j < 4 else 0.0) + r.random() for i in range(side) for j in range(side)}
    rows = [(f"{i}:{j}", v) for (i, j), v in value.items()] + [("alone", 3.0), ("unknown", None)]
    values = spark.createDataFrame(rows, "geoid string, value double")
    pairs = neighbours.contiguity(counties)
    got = {x.geoid: x for x in neighbours.local_moran(values, pairs, 99).collect()}
    every = np.array([v for _, v in rows if v is not None])
    z = {k: (v - every.mean()) / every.std() for k, v in rows if v is not None}
    for i, j in ((0, 0), (3, 3), (5, 5), (11, 0)):
        near = [z[f"{i + a}:{j + b}"] for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1)) if f"{i + a}:{j + b}" in z]
        x = got[f"{i}:{j}"]
        assert x.z == pytest.approx(z[f"{i}:{j}"]) and x.lag == pytest.approx(sum(near) / len(near)) and x.moran == pytest.approx(x.z * x.lag) and x.neighbours == len(near)
    assert got["1:1"].quadrant == "high-high" and got["1:1"].p <= 0.05 and got["8:8"].quadrant == "low-low"
    assert got["alone"].moran is None and got["alone"].p is None and got["alone"].quadrant == "none" and "unknown" not in got
    again = {x.geoid: x.p for x in neighbours.local_moran(values.repartition(5), pairs.repartition(3), 99).collect()}
    other = {x.geoid: x.p for x in neighbours.local_moran(values, pairs, 99, seed=7).collect()}
    assert again == {k: v.p for k, v in got.items()} and again != other


def test_noise_has_no_hot_spots(spark):
    """Of counties with random values about a tenth has a one-sided pseudo-p of 0.05 or less."""
    r = random.Random(9)
    rows = [(f"{i}", r.random()) for i in range(400)]
    pairs = spark.createDataFrame([(f"{i}", f"{(i + d) % 400}") for i in range(400) for d in (-2, -1, 1, 2)], "geoid string, neighbour string")
    p = [x.p for x in neighbours.local_moran(spark.createDataFrame(rows, "geoid string, value double"), pairs, 99).collect()]
    assert 0.03 < sum(x <= 0.05 for x in p) / 400 < 0.2


def test_numbers_are_whole_and_without_gaps(spark):
    df = spark.createDataFrame([(f"g{i}",) for i in range(57)], "geoid string")
    assert sorted(r.number for r in neighbours.numbered(df).collect()) == list(range(57))
    same = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "geoid string, value double")
    pairs = spark.createDataFrame([("a", "b"), ("b", "a")], "geoid string, neighbour string")
    assert [(x.z, x.moran, x.p) for x in neighbours.local_moran(same, pairs, 9).collect()] == [(None, None, None)] * 2


@pytest.mark.parametrize("block, lot, row_draws", [(1 << 15, 661, 4096), (16, 7, 20), (16, 7, 1)])
def test_draws_are_those_of_the_hashes_and_travel_packed(spark, monkeypatch, block, lot, row_draws):
    r = random.Random(4)
    values = spark.createDataFrame([(f"{i}", r.random()) for i in range(120)], "geoid string, value double")
    pairs = spark.createDataFrame([(f"{i}", f"{(i + d) % 120}") for i in range(120) for d in range(1, 3 + i % 5)], "geoid string, neighbour string")
    for name, value in (("BLOCK", block), ("LOT", lot), ("ROW_DRAWS", row_draws)):
        monkeypatch.setattr(neighbours, name, value)
    got = neighbours.local_moran(values, pairs, 130).collect()
    held = neighbours.local_moran(values, pairs)
    known = neighbours.numbered(held.select("geoid", "z"))
    drawn = held.join(known.drop("z"), "geoid").select("*", F.explode(F.sequence(F.lit(1), F.lit(130))).alias("permutation")).select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "neighbours")).alias("place"))
    drawn = drawn.select("geoid", "z", "moran", "number", "permutation", F.pmod(F.xxhash64(F.lit(42), "geoid", "permutation", "place"), F.lit(119)).alias("k")).collect()
    z = {x.number: x.z for x in known.collect()}
    lags, own = {}, {}
    for x in drawn:
        lags.setdefault((x.geoid, x.permutation), []).append(z[x.k + (x.k >= x.number)])
        own[x.geoid] = x.z, x.moran
    above, below = dict.fromkeys(own, 0), dict.fromkeys(own, 0)
    for (g, _), near in lags.items():
        made = own[g][0] * sum(near) / len(near)
        above[g] += made >= own[g][1]
        below[g] += made <= own[g][1]
    assert {x.geoid: x.p for x in got} == {g: pytest.approx((min(above[g], below[g]) + 1) / 131) for g in own}
    plan = neighbours.local_moran(values, pairs, 130)._jdf.queryExecution().toString()
    assert "slots" in plan and "offsets" in plan
