"""Areas on the sphere, shares of cells, rings that cross themselves."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import shapes

from stratus.operators import areas, spatial
from stratus.operators.areas import simple_rings


def planar(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def inside(rings, x, y):
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            n += (ay <= y) != (by <= y) and x < ax + (y - ay) * (bx - ax) / (by - ay)
    return n % 2 == 1


def crosses(rings):
    """Whether any two edges meet but at common ends, or a ring passes a point twice."""
    edges = [(a, b) for r in rings for a, b in zip(r, r[1:] + r[:1], strict=True)]
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    for i, (a, b) in enumerate(edges):
        for c, d in edges[i + 1 :]:
            if side(a, b, c) * side(a, b, d) < -1e-12 and side(c, d, a) * side(c, d, b) < -1e-12:
                return True
    return any(len(set(r)) < len(r) for r in rings)


def test_areas_on_the_sphere(spark):
    octant = [[(0.0, 0.0), (90.0, 0.0), (90.0, 90.0), (0.0, 90.0)]]
    square = [[(10.0, 40.0), (12.0, 40.0), (12.0, 41.0), (10.0, 41.0)], [(10.5, 40.2), (11.0, 40.2), (11.0, 40.7), (10.5, 40.7)]]
    got = {r.geoid: r.a for r in shapes(spark, octant=octant, square=square, back=[r[::-1] for r in square]).select("geoid", areas.area_km2(F.col("rings")).alias("a")).collect()}
    r2 = areas.RADIUS_KM**2
    box = lambda x0, y0, x1, y1: math.radians(x1 - x0) * (math.sin(math.radians(y1)) - math.sin(math.radians(y0))) * r2
    assert got["octant"] == pytest.approx(4 * math.pi * r2 / 8) and got["square"] == pytest.approx(box(10, 40, 12, 41) - box(10.5, 40.2, 11, 40.7)) and got["back"] == pytest.approx(got["square"])


def test_a_slanted_edge_is_integrated_exactly(spark):
    ring = [[(0.0, 0.0), (60.0, 0.0), (60.0, 80.0)]]
    got = shapes(spark, a=ring).select(areas.area_km2(F.col("rings")).alias("a")).first().a
    y = np.linspace(0, 80, 400_001)
    middle = (y[1:] + y[:-1]) / 2
    want = (np.cos(np.radians(middle)) * np.radians(60 - middle * 60 / 80)).sum() * np.radians(y[1]) * areas.RADIUS_KM**2
    assert got == pytest.approx(want, rel=1e-9)


def tiling(seed=4):
    """Counties that fill 0..8 x 0..6 without gaps: quadrilaterals over shaken corners, one of them with an island of another."""
    r = random.Random(seed)
    at = {(i, j): (i * 2 + (r.uniform(-0.7, 0.7) if 0 < i < 4 else 0.0), j * 2 + (r.uniform(-0.7, 0.7) if 0 < j < 3 else 0.0)) for i in range(5) for j in range(4)}
    out = {f"{i}{j}": [[at[i, j], at[i + 1, j], at[i + 1, j + 1], at[i, j + 1]]] for i in range(4) for j in range(3)}
    x, y = (sum(p[k] for p in out["11"][0]) / 4 for k in (0, 1))
    hole = [(x - 0.3, y), (x, y - 0.3), (x + 0.3, y), (x, y + 0.3)]
    return out | {"11": [*out["11"], hole], "99": [hole]}


def test_weights_of_a_cell_add_up_to_one(spark):
    counties = shapes(spark, **tiling())
    centres = [(0.25 + 0.5 * j, 0.25 + 0.5 * i) for i in range(16) for j in range(12)]
    cells = spark.createDataFrame(centres, "lat double, lon double")
    got = areas.area_weights(counties, cells, (0.5, 0.5)).collect()
    total = {}
    for r in got:
        total[r.lat, r.lon] = total.get((r.lat, r.lon), 0) + r.weight
    assert set(total) == set(centres) and all(w == pytest.approx(1, abs=1e-9) for w in total.values())
    own = {r.geoid: r.a for r in counties.select("geoid", areas.area_km2(F.col("rings")).alias("a")).collect()}
    met = {}
    for r in got:
        met[r.geoid] = met.get(r.geoid, 0) + r.area_km2
    assert met == {k: pytest.approx(v) for k, v in own.items()} and len(met) == 13


def test_weighted_means(spark):
    counties = shapes(spark, half=[[(0.0, 0.0), (1.5, 0.0), (1.5, 1.0), (0.0, 1.0)]], far=[[(50.0, 50.0), (51.0, 50.0), (51.0, 51.0)]], part=[[(1.5, 0.0), (3.5, 0.0), (3.5, 1.0), (1.5, 1.0)]])
    cells = spark.createDataFrame([(0.5, 0.5, 10.0), (0.5, 1.5, 40.0), (0.5, 2.5, None), (0.5, 3.5, 7.0)], "lat double, lon double, value double")
    got = {r.geoid: (r.value, r.cells, r.covered) for r in areas.weighted_mean(counties, cells, (1.0, 1.0)).collect()}
    assert got == {"half": (pytest.approx(20.0), 2, pytest.approx(1.0)), "far": (None, 0, 0.0), "part": (pytest.approx(23.5), 2, pytest.approx(0.5))}


def test_cells_at_the_date_line_and_the_poles(spark):
    counties = shapes(spark, west=[[(179.0, 0.0), (180.0, 0.0), (180.0, 1.0), (179.0, 1.0)]], east=[[(-180.0, 0.0), (-179.0, 0.0), (-179.0, 1.0), (-180.0, 1.0)]], pole=[[(0.0, 89.0), (2.0, 89.0), (2.0, 90.0), (0.0, 90.0)]])
    cells = spark.createDataFrame([(0.5, 180.0), (0.5, -180.0), (90.0, 1.0)], "lat double, lon double")
    got = {(r.geoid, r.lat, r.lon): r.weight for r in areas.area_weights(counties, cells, (2.0, 2.0)).collect()}
    assert got == {("west", 0.5, 180.0): pytest.approx(0.25, rel=1e-4), ("east", 0.5, 180.0): pytest.approx(0.25, rel=1e-4), ("west", 0.5, -180.0): pytest.approx(0.25, rel=1e-4), ("east", 0.5, -180.0): pytest.approx(0.25, rel=1e-4), ("pole", 90.0, 1.0): pytest.approx(1.0)}


CASES = {
    "bow tie": ([[(0, 0), (2, 2), (2, 0), (0, 2)]], 2.0, 2),
    "spike": ([[(0, 0), (4, 0), (4, 2), (4, 5), (4, 2), (4, 4), (0, 4)]], 16.0, 1),
    "spike inwards": ([[(0, 0), (4, 0), (4, 2), (2, 2), (4, 2), (4, 4), (0, 4)]], 16.0, 1),
    "hole touching at a point": ([[(0, 0), (4, 0), (4, 4), (0, 4)], [(0, 2), (1, 1), (2, 2), (1, 3)]], 14.0, 2),
    "hole along an edge": ([[(0, 0), (4, 0), (4, 4), (0, 4)], [(0, 1), (2, 1), (2, 3), (0, 3)]], 12.0, 1),
    "hole within": ([[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (2, 1), (2, 2), (1, 2)]], 15.0, 2),
    "two parts that share an edge": ([[(0, 0), (2, 0), (2, 2), (0, 2)], [(2, 0), (4, 0), (4, 2), (2, 2)]], 8.0, 1),
    "parts that overlap": ([[(0, 0), (2, 0), (2, 2), (0, 2)], [(1, 1), (3, 1), (3, 3), (1, 3)]], 6.0, 2),
    "five-pointed star": ([[(round(10 * math.cos(0.4 + 4 * math.pi * k / 5), 6), round(10 * math.sin(0.4 + 4 * math.pi * k / 5), 6)) for k in range(5)]], None, 5),
    "figure of eight in one pass": ([[(0, 0), (2, 0), (2, 2), (4, 2), (4, 4), (2, 4), (2, 2), (0, 2)]], 8.0, 2),
    "twice around": ([[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0), (2, 0), (2, 2), (0, 2)]], 0.0, 0),
    "no area": ([[(0, 0), (1, 1)], [(3, 3)], []], 0.0, 0),
    "closed and repeated": ([[(0, 0), (0, 0), (0, 4), (4, 4), (4, 0), (4, 0), (0, 0)]], 16.0, 1),
}


@pytest.mark.parametrize("name", CASES)
def test_rings_are_mended(name):
    rings, area, n = CASES[name]
    rings = [[(float(x), float(y)) for x, y in r] for r in rings]
    got = simple_rings(rings)
    assert len(got) == n and not crosses(got)
    assert area is None or sum(map(planar, got)) == pytest.approx(area)
    r = random.Random(1)
    points = [(r.uniform(-11, 11), r.uniform(-11, 11)) for _ in range(2000)]
    assert all(inside(rings, *p) == inside(got, *p) for p in points)
    assert sorted(map(sorted, simple_rings(got))) == sorted(map(sorted, got))


@pytest.mark.parametrize("seed", range(8))
def test_random_scribbles(seed):
    r = random.Random(seed)
    rings = [[(r.uniform(0, 10), r.uniform(0, 10)) for _ in range(r.randrange(3, 14))] for _ in range(r.randrange(1, 4))]
    if seed % 2:
        rings = [[(round(x), round(y)) for x, y in ring] for ring in rings]
        rings = [[(float(x), float(y)) for x, y in ring] for ring in rings]
    got = simple_rings(rings)
    assert not crosses(got)
    points = [(r.uniform(0, 10), r.uniform(0, 10)) for _ in range(3000)]
    assert all(inside(rings, *p) == inside(got, *p) for p in points)


def test_mended_tables(spark):
    df = shapes(spark, tie=[[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)]], fine=[[(0.0, 0.0), (3.0, 0.0), (0.0, 3.0)]]).withColumn("name", F.lit("x")).unionByName(shapes(spark, none=[]).withColumn("name", F.lit(None).cast("string")))
    out = areas.mended(df)
    assert out.schema == df.schema
    got = {r.geoid: (r.n, r.a, r.ok) for r in out.select("geoid", F.size("rings").alias("n"), F.aggregate("rings", F.lit(0.0), lambda acc, x: acc + spatial.ring_area(x)).alias("a"), spatial.is_valid(F.col("rings")).alias("ok")).collect()}
    assert got == {"tie": (2, pytest.approx(2.0), True), "fine": (1, pytest.approx(4.5), True), "none": (0, 0.0, False)}
    null = df.limit(1).withColumn("rings", F.when(F.lit(False), F.col("rings")))
    assert areas.mended(null).first().rings is None and areas.mended(df.limit(0)).count() == 0


def test_many_shapes_of_one_partition_are_dealt_to_tasks(spark):
    tie = [[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)]]
    df = shapes(spark, **{f"{k:03d}": tie for k in range(200)}).coalesce(1)
    tasks = areas.mended(df).select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 200


def test_sweeps_find_what_all_pairs_find(monkeypatch):
    r = random.Random(5)
    ring = [(r.uniform(0, 10), r.uniform(0, 10)) for _ in range(40)]
    whole = simple_rings([ring])
    monkeypatch.setattr(areas, "FEW", 4)
    monkeypatch.setattr(areas, "PAIRS", 7)
    assert simple_rings([ring]) == whole and not crosses(whole)
