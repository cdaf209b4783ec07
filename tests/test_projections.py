"""Projections: published worked examples, equal areas, round trips."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import shapes

from stratus.functions import projections
from stratus.functions.projections import BY_CODE, BY_REGION, Albers, Ellipsoid, PolarStereographic, TransverseMercator
from stratus.operators import areas, spatial

CLARKE_1866 = Ellipsoid(6378206.4, 294.9786982)
INTERNATIONAL = Ellipsoid(6378388.0, 297.0)


def forward(spark, p, *points):
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "i int, lon double, lat double")
    return [(r.p.x, r.p.y) for r in df.select("i", p.forward(F.col("lon"), F.col("lat")).alias("p")).orderBy("i").collect()]


def test_published_examples(spark):
    # The manual's numerical examples, to the tenth of a metre that it prints.
    assert forward(spark, Albers(29.5, 45.5, 23.0, -96.0, CLARKE_1866), (-75, 35))[0] == pytest.approx((1885472.7, 1535925.0), abs=0.06)
    assert forward(spark, PolarStereographic(-71.0, -100.0, INTERNATIONAL), (150, -75))[0] == pytest.approx((-1540033.6, -560526.4), abs=0.06)
    assert forward(spark, TransverseMercator(-75.0, 0.9996, 0.0, 0.0, CLARKE_1866), (-73.5, 40.5))[0] == pytest.approx((127106.5, 4484124.4), abs=0.06)


def test_origins_and_the_meridian(spark):
    assert forward(spark, BY_CODE[5070], (-96, 23)) == [pytest.approx((0, 0), abs=1e-6)]
    assert forward(spark, BY_CODE[3031], (0, -90), (90, -71)) == [pytest.approx((0, 0), abs=1e-6), pytest.approx((forward(spark, BY_CODE[3031], (0, -71))[0][1], 0), abs=1e-6)]
    # The length of a meridian's quarter.
    quarter = forward(spark, TransverseMercator(0.0, 1.0, 0.0, 0.0), (0, 90))[0][1]
    e2, phi = projections.WGS84.e2, (np.arange(200_000) + 0.5) * math.pi / 2 / 200_000
    assert quarter == pytest.approx(float((6378137.0 * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5).sum() * math.pi / 2 / 200_000), abs=1e-3)


@pytest.mark.parametrize("name, lons, lats", [("CONUS", (-125, -65), (24, 50)), ("AK", (-188, -130), (50, 72)), ("HI", (-178, -154), (18, 29)), ("PRVI", (-68, -64), (17, 19)), ("GU", (144, 147), (13, 21)), (3995, (-180, 179), (55, 89.9)), (3031, (-179, 180), (-89.9, -55))])
def test_round_trips_within_a_centimetre(spark, name, lons, lats):
    p = BY_REGION.get(name) or BY_CODE[name]
    grid = [(float(x), float(y)) for x in np.linspace(*lons, 13) for y in np.linspace(*lats, 9)]
    df = spark.createDataFrame(grid, "lon double, lat double").select("*", p.forward(F.col("lon"), F.col("lat")).alias("p"))
    for r in df.select("lon", "lat", p.inverse(F.col("p.x"), F.col("p.y")).alias("q")).collect():
        east = (r.q.lon - r.lon + 180) % 360 - 180
        assert math.hypot(east * math.cos(math.radians(r.lat)), r.q.lat - r.lat) * 111_320 < 0.01


def test_areas_are_kept(spark):
    sphere = Ellipsoid(areas.RADIUS_KM * 1000, 0)
    p = Albers(29.5, 45.5, 23.0, -96.0, sphere)
    # Points along the edges, as those bend in the projection.
    edge = lambda a, b: [(a[0] + (b[0] - a[0]) * k / 400, a[1] + (b[1] - a[1]) * k / 400) for k in range(400)]
    corners = [(-100.0, 30.0), (-90.0, 32.0), (-92.0, 41.0), (-101.0, 39.0)]
    df = shapes(spark, a=[[q for a, b in zip(corners, corners[1:] + corners[:1], strict=True) for q in edge(a, b)]])
    whole = df.select(areas.area_km2(F.col("rings")).alias("a")).first().a
    flat = projections.reprojected(df, None, p).select(spatial.ring_area(F.col("rings")[0]).alias("a")).first().a
    assert flat / 1e6 == pytest.approx(whole, rel=1e-6)


def test_reprojected_shapes(spark):
    df = shapes(spark, a=[[(-100.0, 30.0), (-90.0, 32.0), (-92.0, 41.0)]])
    there = projections.reprojected(df, None, BY_CODE[5070])
    back = projections.reprojected(there, BY_CODE[5070])
    assert there.dtypes == back.dtypes == df.dtypes
    assert [(q.lon, q.lat) for q in back.first().rings[0]] == [pytest.approx(v, abs=1e-9) for v in ((-100.0, 30.0), (-90.0, 32.0), (-92.0, 41.0))]
    across = projections.reprojected(there, BY_CODE[5070], BY_CODE[3338])
    assert across.first().rings[0][0].lon == pytest.approx(projections.reprojected(df, None, BY_CODE[3338]).first().rings[0][0].lon, abs=1e-4)
    null = spark.createDataFrame([(None, 1.0)], "lon double, lat double").select(BY_CODE[5070].forward(F.col("lon"), F.col("lat")).alias("p")).first().p
    assert null.x is None and null.y is None
    beyond = spark.createDataFrame([(0.0, 3.0e7)], "x double, y double").select(BY_CODE[5070].inverse(F.col("x"), F.col("y")).alias("p")).first().p
    assert beyond.lat is None


def test_conic_places_at_the_pole_and_past_it(spark):
    p = BY_REGION["CONUS"]
    # Latitudes up to a hundredth of a degree from the pole, beyond it, and once around; longitudes beyond the cut at 84 east.
    places = [(lon, lat) for lon in (-119.95, 83.95, 148.35) for lat in (88.05, 89.15, 89.95, 89.99, 90.05, 134.55, 269.95, 270.05, 293.25)]
    df = spark.createDataFrame(places, "lon double, lat double").select("*", p.forward(F.col("lon"), F.col("lat"), wrapped=False).alias("p"))
    for r in df.select("lon", "lat", p.inverse(F.col("p.x"), F.col("p.y"), F.floor((F.col("lat") + 90) / 180)).alias("q"), p.inverse(F.col("p.x"), F.col("p.y")).alias("near")).collect():
        assert (r.q.lon, r.q.lat) == pytest.approx((r.lon, r.lat), abs=1e-9)
        assert r.near.lat == pytest.approx(math.degrees(math.asin(math.sin(math.radians(r.lat)))), abs=1e-9)
