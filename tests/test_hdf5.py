"""NetCDF-4 files: both forms of the format, dense storage, filters; chunks read by range; the same rows as the classic twin."""

import io

import numpy as np
import pytest
from hdf5_file import netcdf4
from pyspark.sql import functions as F
from test_plans import classic_file

from stratus.sources import grid_source, hdf5
from stratus.sources.grid_source import ClassicFile, GridSource, Wanted, grid_index, opened, read_grids

FORMS = [{"new": False}, {"new": True}, {"new": True, "dense": True, "others": 60}, {"new": False, "fletcher": True}]
LAT, LON, TIMES = np.arange(-30.0, 31.0, 10.0), np.arange(0.0, 90.0, 10.0), np.arange(14.0)


def grid(kind="<f4"):
    r = np.random.default_rng(1)
    return np.round(r.uniform(0, 300, (len(TIMES), len(LAT), len(LON)))).astype(kind)


class Counting(io.BytesIO):
    """Remembers which places were read."""

    def __init__(self, raw):
        super().__init__(raw)
        self.reads = []

    def read(self, n=-1):
        self.reads.append((self.tell(), n))
        return super().read(n)


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("kind", ["<f4", ">f8", "<i2"])
@pytest.mark.parametrize("chunk, filtered", [((1, 7, 9), True), ((4, 3, 5), True), ((3, 7, 2), False), (None, False)])
def test_values(form, kind, chunk, filtered):
    values = grid(kind)
    attrs = {"long_name": "a name", "scale_factor": np.float64(0.5), "add_offset": np.array([10.0]), "note": "x" * 100}
    f = hdf5.File(io.BytesIO(netcdf4(values, LAT, LON, TIMES, chunk, attrs=attrs, filtered=filtered, fill=-5, **form)))
    v = f.datasets["tas"]
    assert v.shape == values.shape and v.fill == -5 and v.attrs["long_name"] == "a name" and v.attrs["scale_factor"] == 0.5
    assert (f.values(v) == values).all() and f.datasets["lat"].attrs["units"] == "degrees_north"
    assert (f.values(v, [(2, 5), (1, 1), (3, 8)]) == values[2:6, 1:2, 3:9]).all()
    assert f.values(f.datasets["lon"]).tolist() == LON.tolist() and len(f.datasets) == 4 + form.get("others", 0)


def test_only_chunks_asked_for_are_read():
    raw = netcdf4(grid(), LAT, LON, TIMES, (2, 3, 3))
    stream = Counting(raw)
    f = hdf5.File(stream)
    v = f.datasets["tas"]
    every = {c.start: c for c in f.chunks(v, [(0, 13), (0, 6), (0, 8)])}
    assert len(every) == 7 * 3 * 3
    stream.reads.clear()
    some = list(f.chunks(v, [(4, 5), (0, 2), (3, 5)]))
    assert [c.start for c in some] == [(4, 0, 3)]
    nodes = len(stream.reads)
    stream.reads.clear()
    list(f.chunks(v, [(0, 13), (0, 6), (0, 8)]))
    assert nodes < len(stream.reads) / 3
    stream.reads.clear()
    f.values(v, [(4, 5), (0, 2), (3, 5)])
    data = {c.address for c in every.values()}
    assert [at for at, _ in stream.reads if at in data] == [every[4, 0, 3].address]


def test_chunks_never_written_hold_the_fill_value(spark, tmp_path):
    values = grid()
    raw = netcdf4(values, LAT, LON, TIMES, (2, 7, 9), fill=-1.0, leave_out=[(4, 0, 0)])
    (tmp_path / "tas_day_NorESM2-LM_historical_r1i1p1f1_gn_2000.nc").write_bytes(raw)
    rows = {(r.time, r.lat, r.lon): r.value for r in read_grids(spark, str(tmp_path)).collect()}
    want = {(t, a, o): None if t in (4.0, 5.0) else float(values[i, j, k]) for i, t in enumerate(TIMES) for j, a in enumerate(LAT) for k, o in enumerate(LON)}
    assert rows == want
    whole = {(r.time, r.lat, r.lon): r.value for r in read_grids(spark, str(tmp_path), whole_files=True).collect()}
    assert whole == want


@pytest.mark.parametrize("form", FORMS)
def test_the_same_rows_as_the_classic_twin(spark, tmp_path, form):
    name = "tas_day_NorESM2-LM_historical_r1i1p1f1_gn_{}.nc"
    old, new = tmp_path / "old", tmp_path / "new"
    old.mkdir()
    new.mkdir()
    for year in (1999, 2000):
        classic_file(old / name.format(year), times=5)
        with open(old / name.format(year), "rb") as stream:
            f = ClassicFile(stream)
            packed = np.where(np.isnan(f.values("tas")), -999.0, f.values("tas")).astype("<f4")
            raw = netcdf4(packed, f.values("lat"), f.values("lon"), f.values("time"), (2, 1, 2), attrs={"_FillValue": np.float32(-999.0)}, **form)
        (new / name.format(year)).write_bytes(raw)

    def rows(folder, *more, **options):
        return sorted((r.path.rsplit("/", 1)[-1], r.variable, r.time, r.lat, r.lon, r.value is None, r.value or 0.0) for r in read_grids(spark, str(folder), *more, **options).collect())

    assert rows(new) == rows(old) and len(rows(new)) == 2 * 5 * 6
    box = Wanted("tas", (1.0, 3.0), (15.0, 25.0), (2.0, 9.0))
    assert rows(new, box, F.col("year") == 2000) == rows(old, box, F.col("year") == 2000) == rows(new, box, F.col("year") == 2000, whole_files=True)
    assert len(rows(new, box)) == 2 * 3 * 2
    assert rows(new, Wanted("pr")) == []
    # The index holds the chunks of the box alone: of 2 x 2 x 3 in a file two steps' rows of the second latitude.
    assert grid_index(spark, str(new), box).count() == 2 * 2 * 2 and grid_index(spark, str(new)).count() == 2 * 3 * 2 * 2
    reader = GridSource({"path": str(new), "time_min": "1", "time_max": "3"}).reader(None)
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 2 * 3 * 6


def test_large_offsets(spark, tmp_path):
    """A chunk beyond 2 GB is read by its place, whatever the file's size; the file here is sparse."""
    values = grid()
    raw = netcdf4(values, LAT, LON, TIMES, (14, 7, 9), filtered=False)
    body = np.ascontiguousarray(values).tobytes()
    at = raw.index(body)
    path = tmp_path / "tas_day_NorESM2-LM_historical_r1i1p1f1_gn_2000.nc"
    far = 3 << 30
    with open(path, "wb") as out:
        out.write(raw.replace(at.to_bytes(8, "little"), far.to_bytes(8, "little")))
        out.seek(far)
        out.write(body)
    got = read_grids(spark, str(tmp_path), Wanted(time=(3.0, 3.0))).collect()
    assert sorted((r.lat, r.lon, r.value) for r in got) == sorted((a, o, float(values[3, j, k])) for j, a in enumerate(LAT) for k, o in enumerate(LON))


def test_what_is_not_read_is_named():
    with pytest.raises(hdf5.Unsupported, match="superblock version 7"):
        hdf5.File(io.BytesIO(hdf5.SIGNATURE + bytes([7]) + bytes(90)))
    with pytest.raises(hdf5.Unsupported, match="filter 4"):
        hdf5.decoded(b"abcd", np.dtype("<f4"), (1,), [4])
    with pytest.raises(ValueError, match="early"):
        raw = netcdf4(grid(), LAT, LON, TIMES, (2, 7, 9))
        f = hdf5.File(io.BytesIO(raw[: len(raw) // 2]))
        f.values(f.datasets["tas"])
    assert isinstance(opened(io.BytesIO(netcdf4(grid(), LAT, LON, TIMES, (2, 7, 9)))), grid_source.Hdf5File)
