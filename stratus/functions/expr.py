"""Coordinate, calendar, unit and naming expressions as Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.regions import REGIONS, SCENARIOS, Region

KELVIN = 273.15
SECONDS_A_DAY = 86400.0

# Columns that may hold a variable, by priority.
TEMPERATURE_COLUMNS = ("tas", "tasmax", "tasmin", "temperature", "temp", "air_temperature", "value")
PRECIPITATION_COLUMNS = ("pr", "precipitation", "precip", "prcp", "rain", "value")

# Inclusive day ranges.
SEASONS = {"DJF": ((335, 366), (1, 59)), "MAM": ((60, 151),), "JJA": ((152, 243),), "SON": ((244, 334),)}
DISPLAY_SEASONS = {"Winter": (1, 59), "Spring": (60, 151), "Summer": (150, 240), "Fall": (244, 334)}


def lon_180(lon: Column) -> Column:
    """0..360 to -180..180; 180 stays."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


def lon_360(lon: Column) -> Column:
    """-180..180 to 0..360."""
    return F.when(lon < 0, lon + 360).otherwise(lon)


def convert_bounds(lon_min: float, lon_max: float, to_360: bool) -> tuple[float, float]:
    """Box bounds in the convention of the data."""
    wrap = (lambda x: x + 360 if x < 0 else x) if to_360 else (lambda x: x - 360 if x > 180 else x)
    return wrap(lon_min), wrap(lon_max)


def in_box(lat: Column, lon: Column, lat_min: float, lat_max: float, lon_min: float, lon_max: float) -> Column:
    """Inclusive on all sides; lon_min over lon_max means a box across the seam."""
    inside = lon.between(lon_min, lon_max) if lon_min <= lon_max else (lon >= lon_min) | (lon <= lon_max)
    return lat.between(lat_min, lat_max) & inside


def in_region(lat: Column, lon: Column, r: Region, is_360: bool = True) -> Column:
    """A region's box for longitudes of either convention."""
    a, b = convert_bounds(r.lon_min, r.lon_max, is_360)
    return in_box(lat, lon, r.lat_min, r.lat_max, a, b)


def convention(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """One row: is_360 and is_indexed of a grid's coordinates."""
    a = df.agg(F.min(lon).alias("x0"), F.max(lon).alias("x1"), F.min(lat).alias("y0"), F.max(lat).alias("y1"))
    return a.select(((F.col("x0") >= 0) & (F.col("x1") > 180)).alias("is_360"), ((F.col("x0") == 0) & (F.col("y0") == 0) & (F.col("x1") < 500) & (F.col("y1") < 200)).alias("is_indexed"), "x0", "x1", "y0", "y1")


def index_to_degrees(index: Column, low: float, high: float, n: int) -> Column:
    """Evenly spaced coordinates from low to high."""
    return F.lit(low) + index * F.lit((high - low) / (n - 1) if n > 1 else 0.0)


def geographic(df: DataFrame, r: Region, n_lat: int, n_lon: int, indexed: bool, is_360: bool) -> DataFrame:
    """Degrees in -180..180: indices are scaled to the region, true degrees are never overwritten."""
    if indexed:
        df = df.withColumns({"lat": index_to_degrees(F.col("lat"), r.lat_min, r.lat_max, n_lat), "lon": index_to_degrees(F.col("lon"), r.lon_min, r.lon_max, n_lon)})
    return df.withColumn("lon", lon_180(F.col("lon"))) if indexed or is_360 else df


def celsius(kelvin: Column) -> Column:
    return kelvin - KELVIN


def mm_a_day(flux: Column) -> Column:
    return flux * SECONDS_A_DAY


def celsius_if_kelvin(df: DataFrame, column: str) -> DataFrame:
    """Converts a whole column when its largest value is over 100; the maximum is a scalar subquery."""
    top = df.agg(F.max(column)).scalar()
    return df.withColumn(column, F.when(top > 100, F.col(column) - KELVIN).otherwise(F.col(column)))


def pick_column(columns: list[str], priority: tuple[str, ...]) -> str:
    """The first column of the priority list that is present, by name and then by part of a name."""
    lower = {c.lower(): c for c in columns}
    for p in priority:
        if p in lower:
            return lower[p]
    for p in priority:
        for c in columns:
            if p in c.lower():
                return c
    raise KeyError(f"none of {priority} among {columns}")


def is_leap(year: Column) -> Column:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def days_in_year(year: Column) -> Column:
    return F.when(is_leap(year), 366).otherwise(365)


def doy_calendar(ts: Column) -> Column:
    return F.dayofyear(ts)


def doy_synthetic(df: DataFrame, keys: list[str], order: str, out: str = "doy") -> DataFrame:
    """Numbers the rows of each file 1..365 and starts again."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(out, ((F.row_number().over(w) - 1) % 365 + 1).cast("int"))


def leap_365(df: DataFrame, year: str = "year", doy: str = "doy") -> DataFrame:
    """Drops day 60 of leap years and moves later days up; other days are held within 365."""
    leap, d = is_leap(F.col(year)), F.col(doy)
    return df.where(~(leap & (d == 60))).withColumn(doy, F.when(leap & (d > 60), d - 1).otherwise(F.least(d, F.lit(365))).cast("int"))


def year_of_name(path: Column) -> Column:
    """The year in a file name: before the version or extension, else the first plausible four digits; NULL without one."""
    stem = F.regexp_extract(path, r"([^/]*)$", 1)
    found = [F.nullif(F.regexp_extract(stem, p, 1), F.lit("")) for p in (r"_(\d{4})(?:_v[\d.]+)?\.nc$", r"_(\d{4})$", r"_(\d{4})_", r"(\d{4})")]
    year = F.coalesce(*found).cast("int")
    return F.when(year.between(1850, 2200), year)


def metadata_of_name(path: Column, pattern: str) -> Column:
    """Struct of the named groups of a model's file pattern, NULL where they are absent."""
    import re

    names = re.findall(r"\(\?<(\w+)>", pattern)
    stem = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.struct(*[F.nullif(F.regexp_extract(stem, pattern, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)])


def scenario_of_year(year: Column) -> Column:
    """The first scenario whose range holds the year."""
    out = F.lit(None).cast("string")
    for name, (a, b) in reversed(SCENARIOS.items()):
        out = F.when(year.between(a, b), name).otherwise(out)
    return out


def geoid5(geoid: Column) -> Column:
    return F.lpad(geoid.cast("string"), 5, "0")


def state_of(geoid: Column) -> Column:
    return F.substring(geoid, 1, 2)


def region_of_state(state: Column) -> Column:
    """The region of a two-character state code; what no region lists is continental."""
    out = F.lit("CONUS")
    for r in REGIONS.values():
        if r.states:
            out = F.when(state.isin(*r.states), r.key).otherwise(out)
    return out


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def season(doy: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, ranges in SEASONS.items():
        out = F.when(reduce(lambda a, b: a | b, (doy.between(*r) for r in ranges)), name).otherwise(out)
    return out


def display_seasons(doy: Column) -> Column:
    """Array of the display seasons that hold the day; two of them overlap."""
    return F.array_compact(F.array(*[F.when(doy.between(a, b), n) for n, (a, b) in DISPLAY_SEASONS.items()]))


def region_of_box(lon_min: Column, lon_max: Column, lat_min: Column, lat_max: Column) -> Column:
    """The region whose box is within 5 degrees of longitude and 2 of latitude on all sides, else CONUS."""
    out = F.lit("CONUS")
    for r in reversed(REGIONS.values()):
        near = (F.abs(lon_min - r.lon_min) < 5) & (F.abs(lon_max - r.lon_max) < 5) & (F.abs(lat_min - r.lat_min) < 2) & (F.abs(lat_max - r.lat_max) < 2)
        out = F.when(near, r.key).otherwise(out)
    return out


def precip_a_high_day(annual: Column, days: Column) -> Column:
    """Annual precipitation by high day, 0 without such days."""
    return F.when(days > 0, annual / days).otherwise(F.lit(0.0))


def climatology_kind(days: Column) -> Column:
    """Label of a table with so many distinct days."""
    return F.when(days >= 365, "daily").when(days == 12, "monthly").when(days == 4, "seasonal").otherwise("annual")
