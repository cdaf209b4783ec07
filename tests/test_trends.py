"""Model calendars, trends and change points against plain versions."""

import itertools
import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.functions import calendars, expr
from stratus.operators import trends


def decoded(spark, rows):
    df = spark.createDataFrame(rows, "offset double, units string, calendar string")
    t = calendars.decoded_time(F.col("offset"), F.col("units"), F.col("calendar"))
    return [None if r.t is None else (r.t.year, r.t.month, r.t.day, r.t.doy, round(r.t.hours, 6)) for r in df.select(t.alias("t")).collect()]


def test_calendars(spark):
    got = decoded(
        spark,
        [
            (0.0, "days since 1850-01-01", "noleap"),
            (59.5, "days since 1850-1-1 00:00:00", "365_day"),
            (365.0 * 3 + 58, "days since 1849-01-01", "noleap"),
            (59.0, "days since 1850-01-01", "all_leap"),
            (359.0, "days since 1850-01-01", "360_day"),
            (-1.0, "days since 1850-01-01", "360_day"),
            (36.0, "hours since 2000-02-28 12:00", "gregorian"),
            (59.0, "days since 1900-01-01", "standard"),
            (90.0, "minutes since 2001-12-31T23:00:00", "NoLeap"),
            (86400.0, "seconds since 2000-02-28", "proleptic_gregorian"),
            (1.0 - 1e-13, "days since 2000-01-01", "noleap"),
            (None, "days since 2000-01-01", "noleap"),
            (1.0, "months since 2000-01-01", "noleap"),
            (1.0, "days since 2000-01-01", "julian"),
            (1.0, "days since 2000-02-30", "noleap"),
            (1.0, "days since 2000-02-30", "360_day"),
        ],
    )
    assert got == [
        (1850, 1, 1, 1, 0.0), (1850, 3, 1, 60, 12.0), (1852, 2, 28, 59, 0.0), (1850, 2, 29, 60, 0.0), (1850, 12, 30, 360, 0.0), (1849, 12, 30, 360, 0.0), (2000, 3, 1, 61, 0.0),
        (1900, 3, 1, 60, 0.0), (2002, 1, 1, 1, 0.5), (2000, 2, 29, 60, 0.0), (2000, 1, 2, 2, 0.0), None, None, None, None, (2000, 3, 1, 61, 0.0),
    ]


def test_round_trips_and_standard_days(spark):
    r = random.Random(2)
    days = [r.randrange(-20_000, 90_000) for _ in range(200)]
    want = [date(1850, 1, 1) + timedelta(d) for d in days]
    got = decoded(spark, [(float(d), "days since 1850-01-01", "standard") for d in days])
    assert [g[:4] for g in got] == [(w.year, w.month, w.day, w.timetuple().tm_yday) for w in want]
    for name in ("noleap", "360_day", "366_day", "standard"):
        df = spark.createDataFrame([(float(d),) for d in days], "o double")
        units, calendar = F.lit("hours since 1850-01-01"), F.lit(name)
        t = df.select("o", calendars.decoded_time(F.col("o") * 24, units, calendar).alias("t"))
        back = t.select("o", calendars.encoded_time(F.col("t.year"), F.col("t.month"), F.col("t.day"), units, calendar).alias("b"))
        assert all(x.b == x.o * 24 for x in back.collect())


def test_days_agree_with_the_library(spark):
    """The 365-day numbers of noleap are those that leap_365() gives to calendar days."""
    days = spark.sql("select explode(sequence(date'1999-01-01', date'2004-12-31')) as d").select(F.year("d").alias("year"), F.month("d").alias("month"), F.dayofmonth("d").alias("day"), F.dayofyear("d").alias("doy"))
    kept = expr.leap_365(days)
    units, calendar = F.lit("days since 1999-01-01"), F.lit("noleap")
    offset = calendars.encoded_time(F.col("year"), F.col("month"), F.col("day"), units, calendar)
    both = kept.select("year", "doy", calendars.decoded_time(offset, units, calendar).alias("t"), offset.alias("o"))
    assert both.count() == 6 * 365 and both.where("t.doy <> doy or t.year <> year or o <> (year - 1999) * 365 + doy - 1").isEmpty()


def test_time_axes_of_files(spark, tmp_path):
    from hdf5_file import netcdf4

    from stratus.sources.grid_files import grid_file
    from stratus.sources.grid_source import read_grids

    values = np.arange(12.0).reshape(3, 2, 2)
    (tmp_path / "tas_day_NorESM2-LM_historical_r1i1p1f1_gn_1850.nc").write_bytes(netcdf4(values, [1.0, 2.0], [3.0, 4.0], [58.0, 59.0, 60.0], (1, 2, 2)))
    (tmp_path / "tas_day_NorESM2-LM_historical_r1i1p1f1_gn_1851.nc").write_bytes(grid_file("tas", np.array([58.0, 59.0, 60.0]), np.array([1.0, 2.0]), np.array([3.0, 4.0]), values, "days since 1852-01-01", "standard"))
    axes = calendars.time_axes(spark, str(tmp_path))
    assert {(r.units, r.calendar) for r in axes.collect()} == {("days since 1850-01-01", "noleap"), ("days since 1852-01-01", "standard")}
    dated = calendars.with_dates(read_grids(spark, str(tmp_path)), axes)
    assert {(r.year, r.month, r.day) for r in dated.select("date.*").collect()} == {(1850, 2, 28), (1850, 3, 1), (1850, 3, 2), (1852, 2, 28), (1852, 2, 29), (1852, 3, 1)} and dated.count() == 24


def test_trends(spark):
    r = random.Random(5)
    rows = [(g, y, v) for g, make in (("up", lambda y: y * 0.5 + r.random()), ("down", lambda y: -y + r.random()), ("flat", lambda y: r.choice((1.0, 2.0))), ("same", lambda y: 3.0)) for y in range(1980, 2015) for v in (make(y),)]
    rows += [("one", 2000, 4.0), ("none", 2000, None), ("twice", 2000, 1.0), ("twice", 2000, 3.0), ("twice", 2002, 5.0), ("nokey", None, 1.0)]
    got = {x.g: x for x in trends.mann_kendall(spark.createDataFrame(rows, "g string, year int, v double"), "v", ("g",)).collect()}
    assert {k: v.trend for k, v in got.items()} == {"up": "increasing", "down": "decreasing", "flat": "no_trend", "same": "no_trend", "one": "no_trend", "twice": "no_trend"}
    assert got["twice"].slope == 1.5 and got["one"].slope is None and got["same"].slope == 0.0 and got["same"].variance == 0.0
    series = [v for g, _, v in rows if g == "flat"]
    pairs = list(itertools.combinations(range(35), 2))
    s = sum((series[j] > series[i]) - (series[j] < series[i]) for i, j in pairs)
    ones, twos = series.count(1.0), series.count(2.0)
    variance = (35 * 34 * 75 - sum(t * (t - 1) * (2 * t + 5) for t in (ones, twos))) / 18
    assert got["flat"].s == s and got["flat"].variance == pytest.approx(variance) and got["flat"].p == pytest.approx(math.erfc(abs((s - (s > 0) + (s < 0)) / math.sqrt(variance)) / math.sqrt(2)))


def best_cut(values, penalty, least):
    """Every cut of a short series."""
    n, best = len(values), None
    for k in range(n // least):
        for cuts in itertools.combinations(range(1, n), k):
            at = [0, *cuts, n]
            if all(b - a >= least for a, b in zip(at, at[1:], strict=False)):
                cost = sum(float(((values[a:b] - values[a:b].mean()) ** 2).sum()) for a, b in zip(at, at[1:], strict=False)) + penalty * k
                if best is None or cost < best[0] - 1e-9:
                    best = cost, at[:-1]
    return best


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_the_cheapest(seed):
    r = np.random.default_rng(seed)
    values = np.concatenate([r.normal(m, 1, 4) for m in r.choice([0, 3, 8], 3)])
    for penalty in (0.5, 4.0, 20.0):
        cost, starts = best_cut(values, penalty, 2)
        got = trends.segments(values, penalty, 2)
        at = [*got, len(values)]
        assert sum(float(((values[a:b] - values[a:b].mean()) ** 2).sum()) for a, b in zip(at, at[1:], strict=False)) + penalty * (len(got) - 1) == pytest.approx(cost)


def test_planted_breaks(spark):
    r = np.random.default_rng(1)
    levels = {"two": [(1950, 0.0), (1970, 6.0), (2000, 2.0)], "none": [(1950, 1.0)], "small": [(1950, 0.0), (1985, 1.5)]}
    rows = [(g, y, float(max(x for x in at if x[0] <= y)[1] + r.normal(0, 1 if g != "none" else 0.0))) for g, at in levels.items() for y in range(1950, 2015)]
    got = trends.change_points(spark.createDataFrame(rows + [("one", 2000, 1.0)], "g string, year int, v double"), "v", ("g",)).collect()
    firsts = {g: [x.first_year for x in sorted(got, key=lambda x: x.segment) if x.g == g] for g in ("two", "none", "small", "one")}
    assert firsts["two"] == [1950, 1970, 2000] and firsts["none"] == [1950] and firsts["one"] == [2000] and len(firsts["small"]) == 2 and abs(firsts["small"][1] - 1985) <= 4
    assert {(x.segment, x.severity) for x in got if x.g == "two"} == {(1, "none"), (2, "severe"), (3, "moderate")} or {(x.segment, x.severity) for x in got if x.g == "two"} == {(1, "none"), (2, "severe"), (3, "severe")}
