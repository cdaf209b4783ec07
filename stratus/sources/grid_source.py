"""NetCDF grids: classic files (CDF-1, CDF-2 and CDF-5) and NetCDF-4 ones, whose HDF5 form sources.hdf5 reads.

read_grids() makes a table of the chunks that the files hold, a row each with its place in the file and its coordinates, from headers and indexes
alone; files are pruned by their names, chunks by the steps and cells asked for. Tasks then read the chunks left, by range, from whatever store
pyarrow opens, so a task holds one chunk at a time and the size of a file doesn't matter. Stores that only Spark opens go by whole files. The Python
data source spark.read.format("stratus_grid").load(path) is for file systems that every executor mounts; it splits a file into
ranges of time steps. All yield Arrow batches of (path, variable, time, lat, lon, value), one time step after the other, of the steps
and cells asked for only.
"""

from __future__ import annotations

import io
import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from stratus.sources import hdf5

SCHEMA = "path string, variable string, time double, lat double, lon double, value double"
NAMES = ["path", "variable", "time", "lat", "lon", "value"]
STEPS_A_TASK = 64
TASK_BYTES = 64 << 20
#: A chunk of a file: where it lies, how it is stored, the coordinates that it covers and how its numbers become values.
INDEX = (
    "path string, variable string, address bigint, size bigint, skipped int, kind string, shape array<int>, filters array<int>, "
    "times array<double>, lats array<double>, lons array<double>, missing array<double>, scale double, shift double"
)
# The format's numbers for types.
_TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}


@dataclass(frozen=True)
class Wanted:
    """The part of a grid that is asked for: a variable and inclusive ranges of time, latitude and longitude as the file numbers them."""

    variable: str | None = None
    time: tuple[float, float] = (-np.inf, np.inf)
    lat: tuple[float, float] = (-np.inf, np.inf)
    lon: tuple[float, float] = (-np.inf, np.inf)

    @staticmethod
    def of(options: dict) -> Wanted:
        """From the options variable, time_min, time_max, lat_min, lat_max, lon_min, lon_max."""
        ranges = {k: (float(options.get(f"{k}_min", -np.inf)), float(options.get(f"{k}_max", np.inf))) for k in ("time", "lat", "lon")}
        return Wanted(options.get("variable"), **ranges)

    def within(self, axis: str, values: np.ndarray) -> np.ndarray:
        low, high = getattr(self, axis)
        return np.flatnonzero((values >= low) & (values <= high))


class ClassicFile:
    """Header of a classic file; values(name) and record(name, i) read data."""

    def __init__(self, stream):
        self.stream = stream
        magic = stream.read(4)
        if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
            raise ValueError("not a classic NetCDF file (HDF5-based files need another reader)")
        self.wide = magic[3] != 1
        #: Bytes of a count.
        self.count = 8 if magic[3] == 5 else 4
        self.records = max(0, self._int(self.count))
        self.dims = [(self._name(), self._int(self.count)) for _ in range(self._list(10))]
        self.attrs = self._attributes()
        self.variables: dict[str, dict] = {}
        for _ in range(self._list(11)):
            name, dims = self._name(), [self._int(self.count) for _ in range(self._int(self.count))]
            attrs, kind, _ = self._attributes(), self._int(), self._int(self.count)
            self.variables[name] = {"dims": dims, "attrs": attrs, "type": _TYPES[kind], "begin": self._int(8) if self.wide else self._int()}
        sizes = [self._width(v) for v in self.variables.values() if self._is_record(v)]
        # Records are padded to four bytes, but not where a file has one record variable alone.
        self.record_size = sizes[0] if len(sizes) == 1 else sum(n + -n % 4 for n in sizes)

    def _int(self, n: int = 4) -> int:
        return struct.unpack(">q" if n == 8 else ">i", self.stream.read(n))[0]

    def _name(self) -> str:
        n = self._int(self.count)
        return self.stream.read(n + -n % 4)[:n].decode()

    def _list(self, tag: int) -> int:
        got, n = self._int(), self._int(self.count)
        if got not in (0, tag):
            raise ValueError("broken header")
        return n

    def _attributes(self) -> dict:
        out = {}
        for _ in range(self._list(12)):
            name, kind, n = self._name(), self._int(), self._int(self.count)
            width = np.dtype(_TYPES[kind]).itemsize * n
            raw = self.stream.read(width + -width % 4)[:width]
            out[name] = raw.decode("utf-8", "replace") if kind == 2 else np.frombuffer(raw, dtype=_TYPES[kind])
        return out

    def _is_record(self, v: dict) -> bool:
        return bool(v["dims"]) and self.dims[v["dims"][0]][1] == 0

    def _width(self, v: dict) -> int:
        """Bytes of one step of a variable."""
        return int(np.prod([self.dims[d][1] for d in v["dims"][1:]], dtype=np.int64)) * np.dtype(v["type"]).itemsize

    def ranks(self) -> dict[str, int]:
        """Dimensions of each variable."""
        return {n: len(v["dims"]) for n, v in self.variables.items()}

    def steps(self, name: str) -> int:
        v = self.variables[name]
        return self.records if self._is_record(v) else self.dims[v["dims"][0]][1]

    def time_attributes(self) -> dict:
        return self.variables["time"]["attrs"] if "time" in self.variables else {}

    def record(self, name: str, i: int) -> np.ndarray:
        """Step i along the first dimension, as doubles with NaN for missing values."""
        v = self.variables[name]
        shape = [self.dims[d][1] for d in v["dims"][1:]]
        kind, width = np.dtype(v["type"]), self._width(v)
        self.stream.seek(v["begin"] + i * (self.record_size if self._is_record(v) else width))
        out = np.frombuffer(self.stream.read(width), dtype=kind).astype(float).reshape(shape)
        return _unpacked(out, v["attrs"])

    def values(self, name: str) -> np.ndarray:
        return np.array([self.record(name, i) for i in range(self.steps(name))])

    def stored(self, name: str, wanted: list[tuple[int, int]]) -> Iterator[tuple[tuple[int, ...], int, int, int]]:
        """Start, address, size and skipped filters of each step of the index ranges wanted."""
        v = self.variables[name]
        each = self.record_size if self._is_record(v) else self._width(v)
        for i in range(wanted[0][0], wanted[0][1] + 1):
            yield (i, *(0 for _ in v["dims"][1:])), v["begin"] + i * each, self._width(v), 0

    def form(self, name: str) -> tuple[str, list[int], list[int], tuple]:
        """Type, shape of a stored piece, filters, and how its numbers become values."""
        v = self.variables[name]
        return v["type"], [1, *(self.dims[d][1] for d in v["dims"][1:])], [], _packing(v["attrs"])


def _packing(attrs: dict) -> tuple[list[float], float, float]:
    """Numbers that stand for missing values, scale and offset."""
    first = lambda key: float(np.ravel(attrs[key])[0])
    missing = [first(key) for key in ("_FillValue", "missing_value") if key in attrs]
    return missing, first("scale_factor") if "scale_factor" in attrs else 1.0, first("add_offset") if "add_offset" in attrs else 0.0


def _unpacked(values: np.ndarray, attrs: dict) -> np.ndarray:
    return _as_values(values, *_packing(attrs))


def _as_values(values: np.ndarray, missing: list[float], scale: float, shift: float) -> np.ndarray:
    """NaN for missing values, and scale and offset applied."""
    for x in missing:
        values[values == x] = np.nan
    return values * scale + shift


class Hdf5File:
    """The same view of a NetCDF-4 file."""

    def __init__(self, stream):
        self.file = hdf5.File(stream)
        self.variables = self.file.datasets
        self.held: tuple | None = None

    def ranks(self) -> dict[str, int]:
        return {n: len(v.shape) for n, v in self.variables.items()}

    def steps(self, name: str) -> int:
        return self.variables[name].shape[0]

    def time_attributes(self) -> dict:
        return self.variables["time"].attrs if "time" in self.variables else {}

    def record(self, name: str, i: int) -> np.ndarray:
        """Step i; the chunks that hold it are kept for the steps that follow."""
        v = self.variables[name]
        first = i // v.chunk[0] * v.chunk[0]
        if self.held is None or self.held[:2] != (name, first):
            last = min(first + v.chunk[0], v.shape[0]) - 1
            self.held = name, first, self.file.values(v, [(first, last), *((0, n - 1) for n in v.shape[1:])])
        return _unpacked(self.held[2][i - first].astype(float), self._attrs(v))

    def values(self, name: str) -> np.ndarray:
        v = self.variables[name]
        return _unpacked(self.file.values(v).astype(float), self._attrs(v))

    @staticmethod
    def _attrs(v: hdf5.Dataset) -> dict:
        """With the fill value of the storage where the attribute is not there."""
        return v.attrs if not v.fill or "_FillValue" in v.attrs else v.attrs | {"_FillValue": v.fill}

    def stored(self, name: str, wanted: list[tuple[int, int]]) -> Iterator[tuple[tuple[int, ...], int, int, int]]:
        v = self.variables[name]
        if v.inline is not None:
            raise hdf5.Unsupported("grids within a header")
        met = {c.start: c for c in self.file.chunks(v, wanted)}
        # Chunks that were never written hold the fill value; they have no place in the file.
        places = product(*(range(a // n * n, b + 1, n) for (a, b), n in zip(wanted, v.chunk, strict=True)))
        for c in (met.get(p, hdf5.Chunk(p, 0, 0)) for p in places):
            yield c.start, c.address, c.size, c.skipped

    def form(self, name: str) -> tuple[str, list[int], list[int], tuple]:
        v = self.variables[name]
        return v.dtype.str, list(v.chunk), v.filters, _packing(self._attrs(v))


class H5pyFile:
    """The same view by the library h5py, where it is installed, of what sources.hdf5 doesn't read; by time steps only."""

    def __init__(self, stream):
        import h5py

        self.file = h5py.File(stream, "r")
        self.variables = {n: v for n, v in self.file.items() if hasattr(v, "shape")}

    def ranks(self) -> dict[str, int]:
        return {n: len(v.shape) for n, v in self.variables.items()}

    def steps(self, name: str) -> int:
        return self.variables[name].shape[0]

    def record(self, name: str, i: int) -> np.ndarray:
        v = self.variables[name]
        return _unpacked(np.array(v[i], dtype=float), dict(v.attrs))

    def values(self, name: str) -> np.ndarray:
        v = self.variables[name]
        return _unpacked(np.array(v[...], dtype=float), dict(v.attrs))


def opened(stream):
    """A file by its first bytes."""
    magic = stream.read(8)
    stream.seek(0)
    if magic != hdf5.SIGNATURE:
        return ClassicFile(stream)
    try:
        return Hdf5File(stream)
    except hdf5.Unsupported:
        from importlib.util import find_spec

        if "h5py" not in sys.modules and find_spec("h5py") is None:
            raise
        stream.seek(0)
        return H5pyFile(stream)


def _axes(f, wanted: Wanted) -> tuple | None:
    """The variable asked for and the file's times, latitudes and longitudes; None where the file hasn't got it."""
    ranks = f.ranks()
    lat_name, lon_name = ("lat", "lon") if "lat" in ranks else ("y", "x")
    variable = wanted.variable or next(n for n, k in ranks.items() if k == 3)
    if variable not in ranks:
        return None
    times = f.values("time") if "time" in ranks else np.arange(f.steps(variable), dtype=float)
    return variable, times, f.values(lat_name), f.values(lon_name)


def _batch(path: str, variable: str, time: float, lat: np.ndarray, lon: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
    n = cells.size
    lats, lons = pa.array(np.repeat(lat, len(lon))), pa.array(np.tile(lon, len(lat)))
    return pa.record_batch([pa.repeat(path, n), pa.repeat(variable, n), pa.array(np.full(n, time)), lats, lons, pa.array(cells.ravel(), from_pandas=True)], names=NAMES)


def decoded(f, path: str, wanted: Wanted, first: int = 0, last: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of the steps from first to before last that are asked for; a file without the variable gives none."""
    axes = _axes(f, wanted)
    if axes is None:
        return
    variable, times, lat, lon = axes
    at_lat, at_lon = wanted.within("lat", lat), wanted.within("lon", lon)
    if not len(at_lat) or not len(at_lon):
        return
    for i in wanted.within("time", times).tolist():
        if first <= i and (last is None or i < last):
            yield _batch(path, variable, float(times[i]), lat[at_lat], lon[at_lon], f.record(variable, i)[np.ix_(at_lat, at_lon)])


def opened_by_range(path: str):
    """A file of any store that pyarrow knows, for reading parts of it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return open("/" + (rest or path).lstrip("/"), "rb")
    store, inner = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")
    return store.open_input_file(inner)


def indexed(f, path: str, wanted: Wanted) -> Iterator[tuple]:
    """A row of INDEX for each chunk of a file that meets the steps and cells asked for."""
    axes = _axes(f, wanted)
    if axes is None:
        return
    variable, *values = axes
    ranges = []
    for axis, v in zip(("time", "lat", "lon"), values, strict=True):
        at = wanted.within(axis, v)
        if not len(at):
            return
        ranges.append((int(at[0]), int(at[-1])))
    kind, shape, filters, (missing, scale, shift) = f.form(variable)
    for start, address, size, skipped in f.stored(variable, ranges):
        covered = [v[s : s + n].tolist() for v, s, n in zip(values, start, shape, strict=True)]
        if all(len(wanted.within(axis, np.array(v))) for axis, v in zip(("time", "lat", "lon"), covered, strict=True)):
            yield path, variable, address, size, skipped, kind, shape, filters, *covered, missing, scale, shift


def grid_index(spark: SparkSession, path: str, wanted: Wanted | None = None, files: Column | None = None, glob: str = "*.nc", model: str = "NorESM2-LM") -> DataFrame:
    """The chunks (INDEX) of the files below a path, a task some files; only headers, axes and indexes are read."""
    part = wanted or Wanted()
    names = [c.split()[0] for c in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with opened_by_range(name) as stream:
                    # Some rows at a time, as coordinates come with each.
                    rows = indexed(opened(stream), name, part)
                    while some := list(islice(rows, 256)):
                        columns = [pa.array(c, t) for c, t in zip(zip(*some, strict=True), _INDEX_TYPES, strict=True)]
                        yield pa.record_batch(columns, names=names)

    return _listed(spark, path, files, glob, model).select("path").mapInArrow(run, INDEX)


_REALS = pa.list_(pa.float64())
_INDEX_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), _REALS, _REALS, _REALS, _REALS, pa.float64(), pa.float64()]


def _listed(spark: SparkSession, path: str, files: Column | None, glob: str, model: str) -> DataFrame:
    """path, length, content (read only if it is asked for) of the files whose names meet a condition."""
    from stratus.sources.catalog import with_metadata

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "length", "content")
    found = with_metadata(found, model)
    return found if files is None else found.where(files)


def read_index(index: DataFrame, wanted: Wanted | None = None, tasks: int = 1) -> DataFrame:
    """The cells (SCHEMA) of the chunks of an index, neighbours in a file in one task."""
    part = wanted or Wanted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, stream = None, None
            try:
                for r in sorted(batch.to_pylist(), key=lambda r: (r["path"], r["address"])):
                    if r["path"] != name:
                        if stream is not None:
                            stream.close()
                        name, stream = r["path"], opened_by_range(r["path"])
                    stream.seek(r["address"])
                    yield from _cells(r, stream.read(r["size"]), part)
            finally:
                if stream is not None:
                    stream.close()

    dealt = index.repartition(tasks, "path", F.floor(F.col("address") / TASK_BYTES))
    return dealt.mapInArrow(run, SCHEMA)


def _cells(r: dict, raw: bytes, wanted: Wanted) -> Iterator[pa.RecordBatch]:
    """A batch for each step of a chunk that is asked for."""
    kind, shape = np.dtype(r["kind"]), tuple(r["shape"])
    block = hdf5.decoded(raw, kind, shape, r["filters"], r["skipped"]) if raw else np.full(shape, r["missing"][0] if r["missing"] else 0, kind)
    times, lat, lon = (np.array(r[k]) for k in ("times", "lats", "lons"))
    at_lat, at_lon = wanted.within("lat", lat), wanted.within("lon", lon)
    for i in wanted.within("time", times).tolist():
        cells = _as_values(block[i][np.ix_(at_lat, at_lon)].astype(float), r["missing"], r["scale"], r["shift"])
        yield _batch(r["path"], r["variable"], float(times[i]), lat[at_lat], lon[at_lon], cells)


def read_grids(spark: SparkSession, path: str, wanted: Wanted | None = None, files: Column | None = None, glob: str = "*.nc", model: str = "NorESM2-LM", whole_files: bool = False) -> DataFrame:
    """The grids below a path, chunk by chunk. `files` is a condition on what the names tell (variable, scenario, year, ...): files that don't meet it are not read.

    The files' lengths are summed first, one number, to set how many tasks read. whole_files takes each through Spark's own file
    system into one task, for stores that nothing else opens; such files must be under 2 GB.
    """
    part = wanted or Wanted()
    found = _listed(spark, path, files, glob, model)
    if not whole_files:
        total = found.agg(F.sum("length")).first()[0] or 0
        return read_index(grid_index(spark, path, wanted, files, glob, model), wanted, max(1, -(-total // TASK_BYTES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                yield from decoded(opened(io.BytesIO(content.as_py())), name.as_py(), part)

    return found.select("path", "content").mapInArrow(run, SCHEMA)


@dataclass
class Steps(InputPartition):
    path: str
    first: int
    last: int


class GridReader(DataSourceReader):
    def __init__(self, options: dict):
        from glob import glob
        from pathlib import Path

        path = options["path"]
        self.wanted = Wanted.of(options)
        self.paths = sorted(glob(f"{path}/**/*.nc", recursive=True)) if Path(path).is_dir() else sorted(glob(path))

    def partitions(self) -> list[InputPartition]:
        """Ranges of the steps of each file; only headers are read here."""
        out: list[InputPartition] = []
        for path in self.paths:
            with open(path, "rb") as stream:
                f = opened(stream)
                variable = self.wanted.variable or next(n for n, k in f.ranks().items() if k == 3)
                n = f.steps(variable) if variable in f.ranks() else 0
            out += [Steps(path, a, min(n, a + STEPS_A_TASK)) for a in range(0, n, STEPS_A_TASK)]
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as stream:
            yield from decoded(opened(stream), partition.path, self.wanted, partition.first, partition.last)


class PushedReader(GridReader):
    """Takes bounds on variable, time, lat and lon from the query's filters; Spark applies them once more."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802  the name is Spark's
        for f in filters:
            axis = f.attribute[0] if hasattr(f, "attribute") else None
            if axis == "variable" and isinstance(f, EqualTo) and self.wanted.variable is None:
                self.wanted = replace(self.wanted, variable=f.value)
            elif axis in ("time", "lat", "lon"):
                low, high = getattr(self.wanted, axis)
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    low = max(low, float(f.value))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    high = min(high, float(f.value))
                self.wanted = replace(self.wanted, **{axis: (low, high)})
            yield f


class GridSource(DataSource):
    """Options: path (a file, pattern or folder on a file system that every executor mounts), those of Wanted.of(), and pushdown: true
    takes bounds from filters, where spark.sql.python.filterPushdown.enabled is set."""

    @classmethod
    def name(cls) -> str:
        return "stratus_grid"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        options = dict(self.options)
        return (PushedReader if str(options.get("pushdown")).lower() == "true" else GridReader)(options)
