"""Grids written as classic NetCDF files (64-bit offsets), a file for each name; sources.file_sink commits them."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the format's own number for a missing double.
MISSING = 9.969209968386869e36
#: Doubles of a file that one group makes.
PIECE = 1 << 16


def grid_head(variable: str, steps: int, lats: np.ndarray, lons: np.ndarray, units: str = "days since 1850-01-01", calendar: str = "noleap") -> bytes:
    """What stands before the records of a file: header, lat and lon."""

    def name(s: str) -> bytes:
        raw = s.encode()
        return struct.pack(">i", len(raw)) + raw + bytes(-len(raw) % 4)

    def attributes(**given) -> bytes:
        out = struct.pack(">ii", 12 if given else 0, len(given))
        for key, value in given.items():
            if isinstance(value, str):
                raw = value.encode()
                out += name(key) + struct.pack(">ii", 2, len(raw)) + raw + bytes(-len(raw) % 4)
            else:
                out += name(key) + struct.pack(">iid", 6, 1, value)
        return out

    n_lat, n_lon = len(lats), len(lons)
    head = b"CDF\x02" + struct.pack(">i", steps) + struct.pack(">ii", 10, 3) + b"".join(name(d) + struct.pack(">i", n) for d, n in (("time", 0), ("lat", n_lat), ("lon", n_lon))) + attributes()
    step = 8 * n_lat * n_lon
    specs = [
        ("lat", [1], attributes(units="degrees_north"), 8 * n_lat),
        ("lon", [2], attributes(units="degrees_east"), 8 * n_lon),
        ("time", [0], attributes(units=units, calendar=calendar), 8),
        (variable, [0, 1, 2], attributes(_FillValue=MISSING), step),
    ]

    def variables(begins: list[int]) -> bytes:
        return struct.pack(">ii", 11, len(specs)) + b"".join(name(s) + struct.pack(f">i{len(dims)}i", len(dims), *dims) + attrs + struct.pack(">iiq", 6, min(size, (1 << 31) - 4), begin) for (s, dims, attrs, size), begin in zip(specs, begins, strict=True))

    start = len(head) + len(variables([0] * 4))
    records = start + 8 * (n_lat + n_lon)
    return head + variables([start, start + 8 * n_lat, records, records + 8]) + np.asarray(lats, ">f8").tobytes() + np.asarray(lons, ">f8").tobytes()


def grid_file(variable: str, times: np.ndarray, lats: np.ndarray, lons: np.ndarray, values: np.ndarray, units: str = "days since 1850-01-01", calendar: str = "noleap") -> bytes:
    """A file of one record variable (time, lat, lon) of doubles; NaN is written as missing."""
    cells = np.where(np.isnan(values), MISSING, values).reshape(len(times), len(lats) * len(lons))
    both = np.concatenate([np.asarray(times, float)[:, None], cells], axis=1).astype(">f8").tobytes()
    return grid_head(variable, len(times), lats, lons, units, calendar) + both


def grid_files(cells: DataFrame, units: str = "days since 1850-01-01", calendar: str = "noleap") -> DataFrame:
    """name, content of the files of cells (name, variable, time, lat, lon, value).

    A file's axes are its distinct coordinates, its cells without a row are missing; of several rows for a cell the last by value counts. A task
    holds one file, such as a year of a region, and the whole of it.
    """

    def run(group: pa.Table) -> pa.Table:
        times, lats, lons = (np.unique(group[c].to_numpy()) for c in ("time", "lat", "lon"))
        values = np.full((len(times), len(lats), len(lons)), np.nan)
        ordered = group.sort_by("value")
        at = [np.searchsorted(axis, ordered[c].to_numpy()) for c, axis in (("time", times), ("lat", lats), ("lon", lons))]
        values[tuple(at)] = ordered["value"].to_numpy()
        raw = grid_file(group["variable"][0].as_py(), times, lats, lons, values, units, calendar)
        return pa.table({"name": group["name"].slice(0, 1), "content": pa.array([raw], pa.binary())})

    return cells.select("name", "variable", "time", "lat", "lon", "value").groupBy("name").applyInArrow(run, "name string, content binary")


def grid_pieces(cells: DataFrame, units: str = "days since 1850-01-01", calendar: str = "noleap") -> DataFrame:
    """name, part, content: the files of grid_files() in pieces, to be put together in the order of part.

    A file's records are one sequence of doubles: of each step the time and then its cells. Cells get their places in it by joins with the numbered
    coordinates of the axes, and PIECE places make a group; a file's axes alone are gathered in one task.
    """
    axes = ("time", "lat", "lon")
    held = cells.select("name", "variable", *[F.coalesce(F.col(a).cast("double"), F.lit(float("nan"))).alias(a) for a in axes], F.col("value").cast("double").alias("value"))
    files = held.groupBy("name").agg(F.first("variable").alias("variable"), *[F.sort_array(F.collect_set(a)).alias(f"{a}s") for a in axes])
    width = F.size("lats").cast("bigint") * F.size("lons") + 1
    of_file = files.select("name", "times", width.alias("width"), (width * F.size("times")).alias("total"))
    times = of_file.select("name", "width", F.posexplode("times").alias("t", "value")).select("name", (F.col("t") * F.col("width")).alias("at"), "value")
    # A row for each piece, as one may have no cell.
    every = of_file.select("name", "total", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("total") - 1) / PIECE))).alias("part")).select("name", "part", F.least(F.lit(PIECE).cast("bigint"), F.col("total") - F.col("part") * PIECE).alias("size"))
    for a in axes:
        numbered = files.select("name", F.posexplode(f"{a}s").alias(f"__{a}", a), F.size(f"{a}s").alias(f"__of_{a}"))
        held = held.join(numbered, ["name", a])
    n_lat, n_lon = F.col("__of_lat").cast("bigint"), F.col("__of_lon")
    placed = held.select("name", (F.col("__time") * (n_lat * n_lon + 1) + 1 + F.col("__lat") * n_lon + F.col("__lon")).alias("at"), "value").unionByName(times)
    placed = placed.select("name", F.floor(F.col("at") / PIECE).alias("part"), (F.col("at") % PIECE).cast("int").alias("at"), "value")

    def piece(group: pa.Table) -> pa.Table:
        sizes = group["size"].drop_null()
        out = np.full(sizes[0].as_py(), np.nan)
        cells = group.filter(group["at"].is_valid()).sort_by("value")
        out[cells["at"].to_numpy()] = cells["value"].to_numpy()
        raw = np.where(np.isnan(out), MISSING, out).astype(">f8").tobytes()
        return pa.table({"name": group["name"].slice(0, 1), "part": group["part"].slice(0, 1), "content": pa.array([raw], pa.binary())})

    def heads(batches):
        for batch in batches:
            for r in batch.to_pylist():
                raw = grid_head(r["variable"], r["steps"], np.array(r["lats"]), np.array(r["lons"]), units, calendar)
                yield pa.record_batch([pa.array([r["name"]]), pa.array([-1], pa.int64()), pa.array([raw], pa.binary())], names=["name", "part", "content"])

    schema = "name string, part bigint, content binary"
    made = placed.unionByName(every, allowMissingColumns=True).groupBy("name", "part").applyInArrow(piece, schema)
    return files.select("name", "variable", F.size("times").alias("steps"), "lats", "lons").mapInArrow(heads, schema).unionByName(made)


def write_grids(cells: DataFrame, path: str, mode: str = "append") -> None:
    """The files of grid_files() below a folder, all or none; made in pieces, so that no task holds a file."""
    from stratus.sources.file_sink import write_pieces

    write_pieces(grid_pieces(cells), path, mode)
