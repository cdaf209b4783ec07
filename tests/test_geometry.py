"""Rings of several parts with holes, whichever way they run; nearest places on long axes."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import HOLE, SQUARE, TWO, grid, shapes

from stratus.operators import spatial

ISLAND = [*HOLE, [(1.5, 1.5), (2.5, 1.5), (2.5, 2.5), (1.5, 2.5)]]


def rings_of(spark, rings, f):
    r = shapes(spark, a=rings).select(f(F.col("rings")).alias("x")).first().x
    return [[(p.lon, p.lat) for p in ring] for ring in r]


@pytest.mark.parametrize("turned", [(), (0,), (1,), (0, 1)])
def test_centroid_whichever_way_rings_run(spark, turned):
    rings = [*SQUARE, [(2.0, 1.0), (3.0, 1.0), (3.0, 2.0), (2.0, 2.0)]]
    rings = [r[::-1] if k in turned else r for k, r in enumerate(rings)]
    c = shapes(spark, a=rings).select(spatial.centroid(F.col("rings")).alias("c")).first().c
    assert (c.lon, c.lat) == pytest.approx(((16 * 2 - 2.5) / 15, (16 * 2 - 1.5) / 15))


def test_depths_and_parts(spark):
    got = shapes(spark, hole=HOLE, two=TWO, island=ISLAND, one=SQUARE).select("geoid", spatial.depths(F.col("rings")).alias("d"), F.size(spatial.parts(F.col("rings"))).alias("n")).collect()
    assert {r.geoid: (r.d, r.n) for r in got} == {"hole": ([0, 1], 1), "two": ([0, 0], 2), "island": ([0, 1, 2], 2), "one": ([0], 1)}


def test_repair(spark):
    broken = [[(0.0, 0.0), (0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 2.0)], [(1.0, 1.0), (3.0, 1.0), (3.0, 1.0), (3.0, 3.0)]]
    got = rings_of(spark, broken, spatial.repaired)
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True)) / 2
    assert [len(r) for r in got] == [4, 3] and [area(r) for r in got] == [16.0, -2.0]


def test_geojson_keeps_parts_and_holes(spark, tmp_path):
    df = shapes(spark, **{"01001": HOLE, "01002": TWO, "01003": ISLAND, "01004": SQUARE}).withColumn("name", F.lit("A"))
    features = [json.loads(r.value) for r in spatial.to_geojson(df).collect()]
    kinds = {f["properties"]["GEOID"]: (f["geometry"]["type"], f["geometry"]["coordinates"]) for f in features}
    assert {k: v[0] for k, v in kinds.items()} == {"01001": "Polygon", "01002": "MultiPolygon", "01003": "MultiPolygon", "01004": "Polygon"}
    assert len(kinds["01001"][1]) == 2 and [len(p) for p in kinds["01003"][1]] == [2, 1]
    assert all(r[0] == r[-1] for k, c in kinds.values() for p in ([c] if k == "Polygon" else c) for r in p)
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    back = spatial.from_geojson(spark.read.option("multiLine", True).json(str(p)))
    ordered = lambda rings: sorted(sorted((q.lon, q.lat) for q in r) for r in rings)
    assert {r.geoid: ordered(r.rings) for r in back.collect()} == {r.geoid: ordered(r.rings) for r in df.collect()}
    cells = grid(spark)
    count = lambda d: {r.geoid: r.n for r in spatial.cells_in_counties(d, cells).groupBy("geoid").agg(F.count("*").alias("n")).collect()}
    assert count(back) == count(df)


def test_nearest_against_a_search_of_the_axis(spark):
    r = np.random.default_rng(3)
    lats, lons = np.unique(np.round(np.cumsum(r.uniform(0.5, 1.5, 37)), 3)), np.unique(np.round(np.cumsum(r.uniform(0.5, 1.5, 41)), 3))
    cells = spark.createDataFrame([(float(a), float(b)) for a in lats for b in lons], "lat double, lon double")
    points = [(str(k), float(x), float(y)) for k, (x, y) in enumerate(zip(r.uniform(-1, 45, 200), r.uniform(-1, 45, 200), strict=True))]
    got = {x.geoid: (x.near_lat, x.near_lon) for x in spatial.nearest_axes(spark.createDataFrame(points, "geoid string, lon double, lat double"), cells).collect()}
    want = {}
    for k, x, y in points:
        near = lambda axis, v: min(axis, key=lambda a: (abs(a - v), a))
        ok = all(axis[0] <= v <= axis[-1] and abs(near(axis, v) - v) <= 0.75 * (axis[-1] - axis[0]) / (len(axis) - 1) for axis, v in ((lats, y), (lons, x)))
        if ok:
            want[k] = (near(lats, y), near(lons, x))
    assert got == want and len(want) > 100


def test_points_that_are_no_grid_are_refused(spark, monkeypatch):
    monkeypatch.setattr(spatial, "MAX_AXIS", 5)
    with pytest.raises(Exception, match="not a grid"):
        spatial.nearest_axes(spark.createDataFrame([("a", 1.0, 1.0)], "geoid string, lon double, lat double"), grid(spark)).collect()
