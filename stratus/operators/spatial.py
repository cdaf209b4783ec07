"""Counties against grid cells: containment, boxes, nearest cells and ring geometry, without a spatial library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import expr

TILE = 1.0
BOX_MARGIN = 0.1
NEAREST_SPACING = 0.75
MAX_AXIS = 100_000


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value being worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _edges(ring: Column) -> Column:
    """Pairs (a, b) of consecutive points, closing the ring."""
    n = F.size(ring)
    return F.transform(ring, lambda p, i: F.struct(p.alias("a"), F.element_at(ring, F.when(i + 1 < n, i + 2).otherwise(1).cast("int")).alias("b")))


def contains(rings: Column, lon: Column, lat: Column) -> Column:
    """Even-odd ray cast over all rings, so holes and several parts come out right; a point on a south or west edge is inside."""

    def crossings(ring: Column) -> Column:
        def crossed(e: Column) -> Column:
            spans = (e["a"]["lat"] <= lat) != (e["b"]["lat"] <= lat)
            slope = (e["b"]["lon"] - e["a"]["lon"]) / F.nullif(e["b"]["lat"] - e["a"]["lat"], F.lit(0.0))
            return spans & (lon < e["a"]["lon"] + (lat - e["a"]["lat"]) * slope)

        return F.size(F.filter(_edges(ring), crossed))

    total = F.aggregate(rings, F.lit(0), lambda acc, ring: acc + crossings(ring))
    return total % 2 == 1


def bbox(rings: Column) -> Column:
    """Struct minx, miny, maxx, maxy."""
    points = F.flatten(rings)
    lons, lats = F.transform(points, lambda p: p["lon"]), F.transform(points, lambda p: p["lat"])
    return F.struct(F.array_min(lons).alias("minx"), F.array_min(lats).alias("miny"), F.array_max(lons).alias("maxx"), F.array_max(lats).alias("maxy"))


def _cross(e: Column) -> Column:
    return e["a"]["lon"] * e["b"]["lat"] - e["b"]["lon"] * e["a"]["lat"]


def ring_area(ring: Column) -> Column:
    """Signed area by the shoelace formula."""
    return F.aggregate(_edges(ring), F.lit(0.0), lambda acc, e: acc + _cross(e)) / 2


def _inside(ring: Column, other: Column) -> Column:
    """Whether most points of a ring lie in another one; boxes are compared first."""
    a, b = bbox(F.array(ring)), bbox(F.array(other))
    boxed = (a["minx"] >= b["minx"]) & (a["maxx"] <= b["maxx"]) & (a["miny"] >= b["miny"]) & (a["maxy"] <= b["maxy"])
    return F.when(boxed, 2 * F.size(F.filter(ring, lambda p: contains(F.array(other), p["lon"], p["lat"]))) > F.size(ring)).otherwise(F.lit(False))


def depths(rings: Column) -> Column:
    """For each ring, how many others hold it: even ones bound a part from outside, odd ones are holes. The way they run doesn't matter."""

    def of(rings: Column) -> Column:
        return F.transform(rings, lambda ring, i: F.size(F.filter(rings, lambda other, j: (i != j) & _inside(ring, other))))

    return F.when(F.size(rings) == 1, F.array(F.lit(0))).otherwise(_let(rings, of))


def oriented(rings: Column) -> Column:
    """The same rings, outer ones anticlockwise and holes clockwise."""
    return F.transform(_with_depth(rings), lambda x: F.when((ring_area(x["ring"]) > 0) == (x["depth"] % 2 == 0), x["ring"]).otherwise(F.reverse(x["ring"])))


def _with_depth(rings: Column) -> Column:
    return _let(rings, lambda r: F.zip_with(r, depths(r), lambda ring, depth: F.struct(ring.alias("ring"), depth.alias("depth"))))


def repaired(rings: Column) -> Column:
    """Rings without points that follow themselves and without the closing point, those without an area left out, oriented by nesting."""

    def distinct(ring: Column) -> Column:
        n = F.size(ring)
        return F.filter(ring, lambda p, i: p != F.element_at(ring, F.when(i == 0, n).otherwise(i).cast("int")))

    return oriented(F.filter(F.transform(rings, distinct), lambda r: (F.size(F.array_distinct(r)) >= 3) & (F.abs(ring_area(r)) > 0)))


def parts(rings: Column) -> Column:
    """The rings by part: each outer ring with the holes that it holds at the next depth."""

    def of(zipped: Column) -> Column:
        holes = lambda o: F.filter(zipped, lambda h: (h["depth"] == o["depth"] + 1) & _inside(h["ring"], o["ring"]))
        return F.transform(F.filter(zipped, lambda x: x["depth"] % 2 == 0), lambda o: F.concat(F.array(o["ring"]), F.transform(holes(o), lambda h: h["ring"])))

    return _let(_with_depth(rings), of)


def centroid(rings: Column) -> Column:
    """Struct lon, lat of the area centroid over all rings, holes being those at an odd depth; the first point for no area."""
    zero = F.struct(F.lit(0.0).alias("area"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, e: Column) -> Column:
        c = _cross(e)
        return F.struct((acc["area"] + c).alias("area"), (acc["x"] + (e["a"]["lon"] + e["b"]["lon"]) * c).alias("x"), (acc["y"] + (e["a"]["lat"] + e["b"]["lat"]) * c).alias("y"))

    first = F.flatten(rings)[0]

    def middle(s: Column) -> Column:
        return F.when(s["area"] == 0, F.struct(first["lon"].alias("lon"), first["lat"].alias("lat"))).otherwise(F.struct((s["x"] / (3 * F.nullif(s["area"], F.lit(0.0)))).alias("lon"), (s["y"] / (3 * F.nullif(s["area"], F.lit(0.0)))).alias("lat")))

    return _let(F.aggregate(F.flatten(F.transform(oriented(rings), _edges)), zero, add), middle)


def is_valid(rings: Column) -> Column:
    """At least one ring, each with three different points and an area."""
    return (F.size(rings) > 0) & F.forall(rings, lambda r: (F.size(F.array_distinct(r)) >= 3) & (F.abs(ring_area(r)) > 0))


def _tiles(low: Column, high: Column, tile: float) -> Column:
    return F.explode(F.sequence(F.floor(low / tile).cast("int"), F.floor(high / tile).cast("int")))


def _tiled(df: DataFrame, minx: Column, miny: Column, maxx: Column, maxy: Column, tile: float) -> DataFrame:
    return df.withColumn("__tx", _tiles(minx, maxx, tile)).withColumn("__ty", _tiles(miny, maxy, tile))


def _with_tile(cells: DataFrame, tile: float) -> DataFrame:
    return cells.withColumn("__tx", F.floor(F.col("lon") / tile).cast("int")).withColumn("__ty", F.floor(F.col("lat") / tile).cast("int"))


def _axes(cells: DataFrame) -> Column:
    """The distinct coordinates of a grid in order, a struct of arrays lats and lons, as a scalar subquery.

    A grid has a few thousand of each. No more than MAX_AXIS and one of either are gathered; where there are more the points are no grid, and
    the query fails and says so.
    """

    def axis(name: str) -> DataFrame:
        return cells.select(F.col(name).alias("x")).where("x is not null").distinct().limit(MAX_AXIS + 1).select(F.lit(name).alias("axis"), "x")

    both = axis("lat").union(axis("lon")).groupBy().agg(*[F.sort_array(F.collect_list(F.when(F.col("axis") == n, F.col("x")))).alias(f"{n}s") for n in ("lat", "lon")])
    fits = F.greatest(F.size("lats"), F.size("lons")) <= MAX_AXIS
    return both.select(F.when(fits, F.struct("lats", "lons")).otherwise(F.raise_error(F.lit(f"more than {MAX_AXIS} distinct coordinates on an axis: not a grid")))).scalar()


def legacy_points(cells: DataFrame) -> DataFrame:
    """lat, lon, at_lat, at_lon: the point that stands for each cell where the mask runs from north to south and the outermost cell
    centres count as the grid's edges. Kept for comparison with results that were made so."""
    axes = _axes(cells)
    i, j = F.array_position("lats", F.col("lat")) - 1, F.array_position("lons", F.col("lon")) - 1
    y0, y1, x0, x1 = F.element_at("lats", 1), F.element_at("lats", -1), F.element_at("lons", 1), F.element_at("lons", -1)
    points = cells.select("lat", "lon").distinct().select("lat", "lon", axes.alias("__axes")).select("lat", "lon", "__axes.lats", "__axes.lons")
    return points.select("lat", "lon", (y1 - (i + 0.5) * (y1 - y0) / F.size("lats")).alias("at_lat"), (x0 + (j + 0.5) * (x1 - x0) / F.size("lons")).alias("at_lon"))


def cells_in_counties(counties: DataFrame, cells: DataFrame, tile: float = TILE, mask: str = "geographic") -> DataFrame:
    """geoid, lat, lon of each distinct cell centre inside a county; mask legacy tests legacy_points() instead of the centres.

    Counties go to the integer tiles of their boxes, so the join is on equal tiles, and the exact test sees few pairs.
    """
    if mask not in ("geographic", "legacy"):
        raise ValueError(f"unknown mask {mask}")
    points = legacy_points(cells) if mask == "legacy" else cells.select("lat", "lon", F.col("lat").alias("at_lat"), F.col("lon").alias("at_lon")).distinct()
    return _inside_counties(counties, points, tile).select("geoid", "lat", "lon")


def _inside_counties(counties: DataFrame, points: DataFrame, tile: float = TILE) -> DataFrame:
    """The points (at_lon, at_lat and what else they have) with the geoid of each county that holds them."""
    b, x, y = F.col("__bbox"), F.col("at_lon"), F.col("at_lat")
    tiled = _tiled(counties.select("geoid", F.col("rings").alias("__rings"), bbox(F.col("rings")).alias("__bbox")), b["minx"], b["miny"], b["maxx"], b["maxy"], tile)
    hits = points.withColumns({"__tx": F.floor(x / tile).cast("int"), "__ty": F.floor(y / tile).cast("int")}).join(tiled, ["__tx", "__ty"])
    inside = x.between(b["minx"], b["maxx"]) & y.between(b["miny"], b["maxy"]) & contains(F.col("__rings"), x, y)
    return hits.where(inside).drop("__tx", "__ty", "__rings", "__bbox")


def cells_in_boxes(counties: DataFrame, cells: DataFrame, margin: float = BOX_MARGIN, tile: float = TILE) -> DataFrame:
    """Every cell column with the geoid of each county whose box, widened by the margin, holds it; counties have a bbox struct."""
    b = F.col("bbox")
    x0, y0, x1, y1 = b["minx"] - margin, b["miny"] - margin, b["maxx"] + margin, b["maxy"] + margin
    tiled = _tiled(counties.select("geoid", "bbox"), x0, y0, x1, y1, tile)
    return _with_tile(cells, tile).join(tiled, ["__tx", "__ty"]).where(F.col("lon").between(x0, x1) & F.col("lat").between(y0, y1)).drop("__tx", "__ty", "bbox")


def nearest_axes(points: DataFrame, cells: DataFrame, spacing: float = NEAREST_SPACING) -> DataFrame:
    """The nearest latitude and the nearest longitude to each point (geoid, lon, lat), each by itself, the lower one on ties.

    Only within `spacing` mean steps on both axes and inside the grid's box. The axes are the distinct coordinates of a grid, a few
    thousand at most; its place among them is found by bisection, and it is compared with the two neighbours there.
    """
    axes = _axes(cells)

    def near(axis: Column, x: Column) -> Column:
        n = F.size(axis)
        start = F.struct(F.lit(0).alias("low"), n.alias("high"))

        def halve(acc: Column, _: Column) -> Column:
            middle = F.shiftright(acc["low"] + acc["high"], 1)
            below = F.get(axis, middle) < x
            return F.when(acc["low"] >= acc["high"], acc).otherwise(F.struct(F.when(below, middle + 1).otherwise(acc["low"]).alias("low"), F.when(below, acc["high"]).otherwise(middle).alias("high")))

        steps = F.sequence(F.lit(0), F.ceil(F.log2(n + F.lit(1))).cast("int"))
        at = F.aggregate(steps, start, halve)["low"]
        beside = F.array_compact(F.array(F.get(axis, at - 1), F.get(axis, at)))
        return F.array_min(F.transform(beside, lambda v: F.struct(F.abs(v - x).alias("d"), v.alias("v"))))["v"]

    def step(axis: Column) -> Column:
        return (F.element_at(axis, -1) - F.element_at(axis, 1)) / F.nullif(F.size(axis) - 1, F.lit(0))

    # Each stage passes an inline(), so that no filter or lambda repeats what stands below it.
    p = points.select("geoid", F.col("lat").alias("y"), F.col("lon").alias("x"), F.inline(F.array(axes)))
    found = F.struct(near(F.col("lats"), F.col("y")).alias("near_lat"), near(F.col("lons"), F.col("x")).alias("near_lon"), step(F.col("lats")).alias("dy"), step(F.col("lons")).alias("dx"), _ends(F.col("lats")).alias("ys"), _ends(F.col("lons")).alias("xs"))
    p = p.select("geoid", "y", "x", F.inline(F.array(found)))
    ok = F.lit(True)
    for x, v, d, ends in (("y", "near_lat", "dy", "ys"), ("x", "near_lon", "dx", "xs")):
        ok = ok & F.col(x).between(F.col(ends)[0], F.col(ends)[1]) & (F.abs(F.col(v) - F.col(x)) <= spacing * F.coalesce(F.col(d), F.lit(0.0)))
    return p.where(ok).select("geoid", "near_lat", "near_lon")


def _ends(axis: Column) -> Column:
    return F.array(F.element_at(axis, 1), F.element_at(axis, -1))


def cell_county(counties: DataFrame, cells: DataFrame, spacing: float = NEAREST_SPACING) -> DataFrame:
    """geoid, lat, lon, is_nearest: contained cells with values, and the nearest one for counties without any.

    cells has lat, lon and value; a cell without a value doesn't count.
    """
    valid = cells.where(F.col("value").isNotNull()).select("lat", "lon")
    inside = cells_in_counties(counties, valid)
    alone = counties.join(inside.select("geoid").distinct(), "geoid", "left_anti").select("geoid", F.inline(F.array(centroid(F.col("rings")))))
    near = nearest_axes(alone, cells.select("lat", "lon").distinct(), spacing).select("geoid", F.col("near_lat").alias("lat"), F.col("near_lon").alias("lon"))
    return inside.withColumn("is_nearest", F.lit(False)).unionByName(near.withColumn("is_nearest", F.lit(True)))


def zonal_mean(counties: DataFrame, cells: DataFrame, spacing: float = NEAREST_SPACING) -> DataFrame:
    """Exactly one row a county: geoid, value, pixel_count, is_nearest; NULL and 0 where no cell serves.

    Values go along with the cells through the tiles; only the nearest cells of counties without any are looked up by their coordinates.
    """
    valued = cells.where(F.col("value").isNotNull()).select(F.col("lat").alias("at_lat"), F.col("lon").alias("at_lon"), "value")
    held = _inside_counties(counties, valued).groupBy("geoid").agg(F.avg("value").alias("held"), F.count("*").alias("n"))
    placed = counties.dropDuplicates(["geoid"]).select("geoid", "rings").join(held, "geoid", "left")
    alone = placed.where("n is null")
    near = nearest_axes(alone.select("geoid", F.inline(F.array(centroid(F.col("rings"))))), cells.select("lat", "lon"), spacing)
    found = near.join(cells.select(F.col("lat").alias("near_lat"), F.col("lon").alias("near_lon"), F.col("value").alias("near")), ["near_lat", "near_lon"]).groupBy("geoid").agg(F.avg("near").alias("near"), F.count("near").alias("near_n"))
    n = F.coalesce("n", "near_n", F.lit(0)).alias("pixel_count")
    return placed.select("geoid", "held", "n").join(found, "geoid", "left").select("geoid", F.coalesce("held", "near").alias("value"), n, F.col("near_n").isNotNull().alias("is_nearest"))


def counties_of_region(counties: DataFrame, *keys: str) -> DataFrame:
    """Counties of the regions named, each once."""
    from stratus.regions import region

    state = expr.state_of(F.col("geoid"))
    hit = F.lit(False)
    for r in map(region, keys):
        hit = hit | (state.isin(*r.states) if r.states else ~state.isin(*r.excluded))
    return counties.where(hit).dropDuplicates(["geoid"])


def counties_in_conus_box(counties: DataFrame) -> DataFrame:
    """Counties whose box lies in the continental one."""
    b = F.col("bbox")
    return counties.where((b["minx"] >= -130) & (b["maxx"] <= -60) & (b["miny"] >= 20) & (b["maxy"] <= 50))


def sample_counties(counties: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n counties, always the same ones for a seed: those of the least digests of id and seed."""
    return counties.orderBy(F.md5(F.concat_ws(":", "geoid", F.lit(str(seed))).cast("binary")), "geoid").limit(n)


def from_geojson(features: DataFrame) -> DataFrame:
    """Counties of a GeoJSON table with one column `features`, read with multiLine; the rings of all parts, which parts() tells apart."""
    f = features.select(F.explode("features").alias("f"))
    # Where polygons and multipolygons stand side by side, the inferred type has text at the depth at which they differ.
    text = F.regexp_replace(F.to_json("f.geometry.coordinates"), '"', "")
    by_part = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json(text, "array<array<array<double>>>"))).otherwise(F.from_json(text, "array<array<array<array<double>>>>"))
    # A closing point repeats the first one; rings here go without it.
    open_ = lambda r: F.when((F.size(r) > 1) & (r[0] == F.element_at(r, -1)), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r)
    rings = F.transform(F.flatten(by_part), lambda r: F.transform(open_(r), lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))))
    return f.select(expr.geoid5(F.col("f.properties.GEOID")).alias("geoid"), F.col("f.properties.NAME").alias("name"), rings.alias("rings"))


def to_geojson(counties: DataFrame) -> DataFrame:
    """One GeoJSON feature a row, as text: a Polygon, or a MultiPolygon where there are several parts, each with its own holes; rings are closed."""

    def closed(ring: Column) -> Column:
        points = F.transform(ring, lambda p: F.array(p["lon"], p["lat"]))
        return F.when(ring[0] == F.element_at(ring, -1), points).otherwise(F.concat(points, F.array(F.get(points, F.lit(0)))))

    coords = F.transform(parts(oriented(F.col("rings"))), lambda part: F.transform(part, closed))
    head = [F.lit("Feature").alias("type"), F.struct(F.col("geoid").alias("GEOID"), F.col("name").alias("NAME")).alias("properties")]
    one = F.to_json(F.struct(*head, F.struct(F.lit("Polygon").alias("type"), F.get(F.col("coords"), F.lit(0)).alias("coordinates")).alias("geometry")))
    several = F.to_json(F.struct(*head, F.struct(F.lit("MultiPolygon").alias("type"), F.col("coords").alias("coordinates")).alias("geometry")))
    return counties.select("geoid", "name", coords.alias("coords")).select(F.when(F.size("coords") > 1, several).otherwise(one).alias("value"))
