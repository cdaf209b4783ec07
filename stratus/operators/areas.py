"""Areas on the sphere, shares of cells that lie in counties, and rings that cross themselves.

Edges are straight in longitude and latitude. Areas are in square kilometres on a sphere of RADIUS_KM and exact for such edges:
the area under an edge is the integral of the sine of the latitude along it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import atan2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.operators.spatial import TILE, _edges, _let, _tiled, bbox, oriented

RADIUS_KM = 6371.0088
#: Crossings nearer than this, in degrees, are one point.
SNAP = 1e-9
NODING_ROUNDS = 5
#: Segments up to this many are compared all at once, more of them this many pairs at a time.
FEW = 128
PAIRS = 8192


def ring_area_km2(ring: Column) -> Column:
    """Signed area of a ring, positive where it runs anticlockwise."""

    def under(e: Column) -> Column:
        half = F.radians(e["b"]["lat"] - e["a"]["lat"]) / 2
        middle = F.sin(F.radians((e["a"]["lat"] + e["b"]["lat"]) / 2))
        return F.radians(e["b"]["lon"] - e["a"]["lon"]) * middle * F.when(half == 0, 1.0).otherwise(F.sin(half) / F.nullif(half, F.lit(0.0)))

    return -F.aggregate(_edges(ring), F.lit(0.0), lambda acc, e: acc + under(e)) * RADIUS_KM**2


def area_km2(rings: Column) -> Column:
    """Area of all parts less their holes, whichever way rings run."""
    return F.aggregate(oriented(rings), F.lit(0.0), lambda acc, ring: acc + ring_area_km2(ring))


def box_area_km2(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.radians(x1 - x0) * (F.sin(F.radians(y1)) - F.sin(F.radians(y0))) * RADIUS_KM**2


def _half(ring: Column, axis: str, bound: Column, keep_above: bool) -> Column:
    """What of a ring lies on one side of a line of constant longitude or latitude; along the line it runs to and fro, which adds no area."""
    other = "lat" if axis == "lon" else "lon"
    inside = lambda p: p[axis] >= bound if keep_above else p[axis] <= bound

    def cut(e: Column) -> Column:
        a, b = e["a"], e["b"]
        t = (bound - a[axis]) / F.nullif(b[axis] - a[axis], F.lit(0.0))
        met = {axis: bound, other: a[other] + t * (b[other] - a[other])}
        crossing = F.struct(met["lon"].alias("lon"), met["lat"].alias("lat"))
        end = F.struct(b["lon"].alias("lon"), b["lat"].alias("lat"))
        return F.when(inside(a) & inside(b), F.array(end)).when(inside(a), F.array(crossing)).when(inside(b), F.array(crossing, end)).otherwise(F.slice(F.array(end), F.lit(1), F.lit(0)))

    return F.flatten(F.transform(_edges(ring), cut))


def clipped(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A ring cut to a box, one half-plane after the other; empty where they don't meet."""
    return _let(_let(_let(_half(ring, "lon", x0, True), lambda r: _half(r, "lon", x1, False)), lambda r: _half(r, "lat", y0, True)), lambda r: _half(r, "lat", y1, False))


def area_weights(counties: DataFrame, cells: DataFrame, step: tuple[float, float], tile: float = TILE) -> DataFrame:
    """geoid, lat, lon, weight, area_km2: of each distinct cell the share of its area that lies in a county, and that area; none where they only touch.

    `step` is the height and width of a cell in degrees around its centre; boxes end at the poles and go on beyond the date line. Counties
    and cells meet by the tiles of their boxes, each pair in the first tile that both have, and only pairs whose boxes overlap are clipped.
    """
    dy, dx = step
    centre = cells.select("lat", "lon").distinct()
    # A box that passes the date line also stands on its other side.
    shift = F.explode(F.array_compact(F.array(F.lit(0.0), F.when(F.col("lon") + dx / 2 > 180, F.lit(-360.0)), F.when(F.col("lon") - dx / 2 < -180, F.lit(360.0)))))
    box = centre.withColumn("shift", shift).select(
        "lat", "lon", (F.col("lon") + F.col("shift") - dx / 2).alias("x0"), F.greatest(F.col("lat") - dy / 2, F.lit(-90.0)).alias("y0"), (F.col("lon") + F.col("shift") + dx / 2).alias("x1"), F.least(F.col("lat") + dy / 2, F.lit(90.0)).alias("y1")
    )
    b = F.col("b")
    shapes = counties.select("geoid", oriented(F.col("rings")).alias("rings"), bbox(F.col("rings")).alias("b"))
    shapes = _tiled(shapes, b["minx"], b["miny"], b["maxx"], b["maxy"], tile)
    pairs = _tiled(box, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), tile).join(shapes, ["__tx", "__ty"])
    low_x, low_y = F.greatest("x0", b["minx"]), F.greatest("y0", b["miny"])
    once = (F.floor(low_x / tile) == F.col("__tx")) & (F.floor(low_y / tile) == F.col("__ty"))
    overlap = (low_x < F.least("x1", b["maxx"])) & (low_y < F.least("y1", b["maxy"]))
    part = F.aggregate("rings", F.lit(0.0), lambda acc, ring: acc + ring_area_km2(clipped(ring, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))))
    cut = pairs.where(once & overlap).select("geoid", "lat", "lon", part.alias("area_km2"), box_area_km2(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("whole"))
    # Cells a hair's breadth inside are as many as roundings make them.
    return cut.where(F.col("area_km2") > F.col("whole") * 1e-12).groupBy("geoid", "lat", "lon").agg((F.sum("area_km2") / F.max("whole")).alias("weight"), F.sum("area_km2").alias("area_km2"))


def weighted_mean(counties: DataFrame, cells: DataFrame, step: tuple[float, float], tile: float = TILE) -> DataFrame:
    """Exactly one row a county: geoid, value (mean of the cells' values by the area in the county), cells (with a value), covered (share of the county's area that they cover).

    Cells without a value don't count; a county that meets none has NULL, 0 and 0.0. A cell given twice counts with both values.
    """
    valued = cells.where(F.col("value").isNotNull()).groupBy("lat", "lon").agg(F.sum("value").alias("total"), F.count("*").alias("n"))
    parts = area_weights(counties, valued, step, tile).join(valued, ["lat", "lon"])
    area = F.sum(F.col("area_km2") * F.col("n"))
    means = parts.groupBy("geoid").agg((F.sum(F.col("area_km2") * F.col("total")) / F.nullif(area, F.lit(0.0))).alias("value"), F.count("*").alias("cells"), F.sum("area_km2").alias("met"))
    whole = counties.select("geoid", area_km2(F.col("rings")).alias("own")).groupBy("geoid").agg(F.sum("own").alias("own"))
    return whole.join(means, "geoid", "left").select("geoid", "value", F.coalesce("cells", F.lit(0)).alias("cells"), F.coalesce(F.col("met") / F.nullif(F.col("own"), F.lit(0.0)), F.lit(0.0)).alias("covered"))


def mended(counties: DataFrame, rings: str = "rings") -> DataFrame:
    """All columns, with the rings made valid: simple rings around the same even-odd area, outer ones anticlockwise and holes clockwise.

    Where rings cross, touch or run along each other they are cut; stretches that are passed an even number of times bound nothing and go, and
    so do spikes; the faces left are walked with the area on the left. Rings that are simple and apart come out as they are, but for direction,
    first point and points that follow themselves. A null list stays null; an empty area is an empty list. Counties are dealt to the tasks of a
    shuffle first, as a file of many small shapes may be one partition; a task has one county's rings as Python objects at a time.
    """
    place, spark = counties.columns.index(rings), counties.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            made = pa.concat_arrays([pa.array([one(r.as_py())], column.type) for r in column]) if len(column) else column
            yield batch.set_column(place, batch.schema.field(place), made)

    def one(r: list | None) -> list | None:
        return None if r is None else [[{"lon": x, "lat": y} for x, y in ring] for ring in simple_rings([[(p["lon"], p["lat"]) for p in ring] for ring in r])]

    return counties.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(run, counties.schema)


def _boxed(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """i, j of the pairs of segments whose boxes meet, in the order of their western sides and some thousands at a time."""
    order = np.argsort(low[:, 0], kind="stable")
    low, high = low[order], high[order]
    if len(low) <= FEW:
        meet = np.triu((low[None, :, 0] <= high[:, None, 0]) & (low[None, :, 1] <= high[:, None, 1]) & (high[None, :, 1] >= low[:, None, 1]), 1)
        i, j = np.nonzero(meet)
        yield order[i], order[j]
        return
    held, n = [], 0
    ends = np.searchsorted(low[:, 0], high[:, 0], "right")
    for rank in range(len(low)):
        # Segments that begin further west were compared already.
        js = np.arange(rank + 1, ends[rank])
        js = js[(low[js, 1] <= high[rank, 1]) & (high[js, 1] >= low[rank, 1])]
        held.append((np.full(len(js), rank), js))
        n += len(js)
        if n >= PAIRS or rank == len(low) - 1:
            i, j = (np.concatenate(x) for x in zip(*held, strict=True))
            yield order[i], order[j]
            held, n = [], 0


def _crossings(a: np.ndarray, b: np.ndarray) -> list[list[tuple[float, float]]]:
    """For each segment a[i] b[i] the points where others meet it, ends and stretches in common included."""
    found: list[list[tuple[float, float]]] = [[] for _ in a]
    for i, j in _boxed(np.minimum(a, b) - SNAP, np.maximum(a, b) + SNAP):
        d, e, w = b[i] - a[i], b[j] - a[j], a[j] - a[i]
        cross = d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = (w[:, 0] * e[:, 1] - w[:, 1] * e[:, 0]) / cross, (w[:, 0] * d[:, 1] - w[:, 1] * d[:, 0]) / cross
            across = (np.abs(cross) > 1e-14 * np.hypot(d[:, 0], d[:, 1]) * np.hypot(e[:, 0], e[:, 1])) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        points = a[i[across]] + t[across, None] * d[across]
        for x, y, point in zip(i[across].tolist(), j[across].tolist(), map(tuple, points.tolist()), strict=True):
            found[x].append(point)
            found[y].append(point)
        # Ends that lie on the other segment, as those of collinear ones do.
        for ends, k in ((a[j], i), (b[j], i), (a[i], j), (b[i], j)):
            on = _on(ends, a[k], b[k])
            for x, point in zip(k[on].tolist(), map(tuple, ends[on].tolist()), strict=True):
                found[x].append(point)
    return found


def _on(points: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether each point lies on its segment."""
    d, w = q - p, points - p
    n = d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1]
    t = (w[:, 0] * d[:, 0] + w[:, 1] * d[:, 1]) / n
    return (t >= -SNAP) & (t <= 1 + SNAP) & (np.abs(d[:, 0] * w[:, 1] - d[:, 1] * w[:, 0]) <= SNAP * np.sqrt(n))


def _noded(rings: list[list[tuple[float, float]]]) -> set[tuple]:
    """Stretches between points where rings meet, as (lesser end, greater end), of those that are passed an odd number of times."""
    snap = lambda p: (round(p[0] / SNAP) * SNAP, round(p[1] / SNAP) * SNAP)
    # Points keep their own coordinates; those that others fall upon lend them theirs.
    names: dict[tuple[float, float], tuple[float, float]] = {}
    named = lambda p: names.setdefault(snap(p), (float(p[0]), float(p[1])))
    edges: set[tuple] = set()
    for ring in rings:
        points = [named(p) for p in ring]
        for p, q in zip(points, points[1:] + points[:1], strict=True):
            if p != q:
                edges ^= {(min(p, q), max(p, q))}
    for _ in range(NODING_ROUNDS):
        held = sorted(edges)
        if not held:
            break
        ends = np.array(held)
        cut: set[tuple] = set()
        for (p, q), met in zip(held, _crossings(ends[:, 0], ends[:, 1]), strict=True):
            stops = sorted({named(x) for x in met} | {p, q}, key=lambda x: (x[0] - p[0]) * (q[0] - p[0]) + (x[1] - p[1]) * (q[1] - p[1]))  # noqa: B023
            for x, y in zip(stops, stops[1:], strict=False):
                cut ^= {(min(x, y), max(x, y))}
        if cut == edges:
            break
        edges = cut
    return edges


def simple_rings(rings: list[list[tuple[float, float]]]) -> list[list[tuple[float, float]]]:
    """Simple rings around the even-odd area of any rings."""
    edges = sorted(_noded(rings))
    if not edges:
        return []
    around: dict[tuple, list[tuple]] = {}
    for p, q in edges:
        around.setdefault(p, []).append(q)
        around.setdefault(q, []).append(p)
    for p, near in around.items():
        near.sort(key=lambda q: atan2(q[1] - p[1], q[0] - p[0]))  # noqa: B023
    ends = np.array(edges)
    out, walked = [], set()
    for start in [e for p, q in edges for e in ((p, q), (q, p))]:
        if start in walked:
            continue
        walk, step = [], start
        while step not in walked:
            walked.add(step)
            walk.append(step[0])
            near = around[step[1]]
            # The next edge clockwise from the one that led here keeps the same face on the left.
            step = step[1], near[near.index(step[0]) - 1]
        if _area_on_left(start, ends):
            out += _loops(walk)
    return out


def _area_on_left(step: tuple, ends: np.ndarray) -> bool:
    """Whether the even-odd area lies on the left of an edge: by the edges west of its middle, or south of it if it is level."""
    (x0, y0), (x1, y1) = step
    axis = 1 if y0 != y1 else 0
    middle = np.array([(x0 + x1) / 2, (y0 + y1) / 2])
    a, b = ends[:, 0], ends[:, 1]
    spans = (a[:, axis] <= middle[axis]) != (b[:, axis] <= middle[axis])
    a, b = a[spans], b[spans]
    at = a[:, 1 - axis] + (middle[axis] - a[:, axis]) * (b[:, 1 - axis] - a[:, 1 - axis]) / (b[:, axis] - a[:, axis])
    own = ((a == step[0]) | (a == step[1])).all(axis=1) & ((b == step[0]) | (b == step[1])).all(axis=1)
    odd = int((at[~own] < middle[1 - axis]).sum()) % 2 == 1
    # West is on the left of what runs north, south on the left of what runs west.
    return odd == (y1 > y0 if axis else x1 < x0)


def _loops(walk: list[tuple]) -> list[list[tuple]]:
    """A walk cut at points that it passes again."""
    out, path, at = [], [], {}
    for p in walk:
        if p in at:
            loop = path[at[p] :]
            for x in loop[1:]:
                del at[x]
            del path[at[p] + 1 :]
            out.append(loop)
        else:
            at[p] = len(path)
            path.append(p)
    return [r for r in (*out, path) if len(r) > 2]
