"""Dataset contracts as column predicates: each adds boolean columns or lists the rules that a record breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import expr
from stratus.regions import REGIONS, VARIABLES

# Readings a grid may hold, in source units.
VALUE_RANGES = {"pr": (0.0, 0.001), "tas": (200.0, 350.0), "tasmax": (200.0, 350.0), "tasmin": (200.0, 350.0)}
# Coordinate bounds for files of a region, in -180..180: lat, lat, lon, lon.
COORDINATE_BOUNDS = {"CONUS": (20.0, 55.0, -135.0, -60.0), "AK": (50.0, 75.0, -180.0, -125.0), "HI": (15.0, 30.0, -180.0, -150.0), "PRVI": (15.0, 20.0, -70.0, -60.0), "GU": (10.0, 25.0, 140.0, 150.0)}
ID_PATTERN = r"^[a-z]+_[A-Z]+_[a-z0-9]+_\d{4}$"
STATUSES = ("pending", "processing", "completed", "failed", "validated", "archived")
LON_SLACK, LAT_SLACK, SIZE_SLACK = 5.0, 2.0, 1024


def valid_lon(x: Column) -> Column:
    return x.between(-180, 360)


def valid_lat(x: Column) -> Column:
    return x.between(-90, 90)


def valid_year(x: Column) -> Column:
    return x.between(1950, 2100)


def valid_window(start: Column, end: Column, target: Column, length: int = 30) -> Column:
    """A window of the length that holds the target year."""
    return (end - start + 1 == length) & target.between(start, end)


def valid_relative_path(path: Column, extensions: tuple[str, ...] = ("nc", "csv", "parquet", "json")) -> Column:
    """Relative, without a step up, with a known extension."""
    return ~path.startswith("/") & ~path.rlike(r"(^|/)\.\.(/|$)") & F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)).isin(*extensions)


def dataset_id(variable: Column, region: Column, scenario: Column, year: Column) -> Column:
    return F.concat_ws("_", variable, region, scenario, year.cast("string"))


def valid_id(id_: Column, variable: Column, region: Column, scenario: Column, year: Column) -> Column:
    """The id has the form and names the record's own parts."""
    return id_.rlike(ID_PATTERN) & (id_ == dataset_id(variable, region, scenario, year))


def _region_bounds(region: Column, field: str) -> Column:
    out = F.lit(None).cast("double")
    for r in REGIONS.values():
        bounds = dict(zip(("lon_min", "lon_max"), expr.convert_bounds(r.lon_min, r.lon_max, False), strict=True)) | {"lat_min": r.lat_min, "lat_max": r.lat_max}
        out = F.when(region == r.key, F.lit(bounds[field])).otherwise(out)
    return out


def within_region(df: DataFrame) -> Column:
    """The record's bounds lie in its region's box, with slack."""
    b, r = F.col("spatial_bounds"), F.col("region")
    lon_ok = (b["min_lon"] >= _region_bounds(r, "lon_min") - LON_SLACK) & (b["max_lon"] <= _region_bounds(r, "lon_max") + LON_SLACK)
    lat_ok = (b["min_lat"] >= _region_bounds(r, "lat_min") - LAT_SLACK) & (b["max_lat"] <= _region_bounds(r, "lat_max") + LAT_SLACK)
    return lon_ok & lat_ok


def broken_rules(df: DataFrame) -> DataFrame:
    """Adds errors and warnings (arrays) and valid for contract records (id, variable, region, scenario, target_year, status, ...)."""
    p, q, a = F.col("processing_metadata"), F.col("quality_metrics"), F.col("data_access")
    errors = {
        "id": ~valid_id(F.col("id"), F.col("variable"), F.col("region"), F.col("scenario"), F.col("target_year")),
        "variable": ~F.col("variable").isin(*VARIABLES),
        "status": ~F.col("status").isin(*STATUSES),
        "target_year": ~valid_year(F.col("target_year")) | ~F.col("target_year").between(p["window_start"], p["window_end"]),
        "bounds": ~(valid_lon(F.col("spatial_bounds")["min_lon"]) & valid_lat(F.col("spatial_bounds")["min_lat"]) & (F.col("spatial_bounds")["min_lat"] < F.col("spatial_bounds")["max_lat"])),
        "quality_score": ~q["quality_score"].between(0, 1) | ~q["completeness_ratio"].between(0, 1),
        "file_path": ~valid_relative_path(a["file_path"]),
    }
    warnings = {"region": ~within_region(df), "window": p["window_end"] - p["window_start"] + 1 != 30, "flags": F.size(q["quality_flags"]) > 0, "sources": F.size(p["source_files"]) == 0}

    def named(rules: dict[str, Column]) -> Column:
        return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), name) for name, c in rules.items()]))

    return df.withColumns({"errors": named(errors), "warnings": named(warnings)}).withColumn("valid", F.size("errors") == 0)


def ready_for_metrics(df: DataFrame, at_least: float = 0.95) -> Column:
    """Completed, valid, of good quality and compatible, with a file that exists."""
    return (F.col("status") == "completed") & F.col("valid") & (F.col("quality_score") >= at_least) & F.col("compatible") & F.col("file_exists")


def file_checks(contracts: DataFrame, files: DataFrame) -> DataFrame:
    """id, exists, size_ok, checksum_ok: contracts (id, path, size, checksum) against binaryFile rows (path, length, content)."""
    seen = files.select("path", "length", F.sha2("content", 256).alias("sha"))
    j = contracts.join(seen, "path", "left")
    return j.select("id", F.col("length").isNotNull().alias("exists"), F.coalesce(F.abs(F.col("length") - F.col("size")) <= SIZE_SLACK, F.lit(False)).alias("size_ok"), F.coalesce(F.col("sha") == F.col("checksum"), F.lit(False)).alias("checksum_ok"))


def grid_checks(df: DataFrame, variable: str, value: str = "value") -> DataFrame:
    """One row: rows, missing_percent, below, above and whether values, missing share and coordinates are acceptable."""
    lo, hi = VALUE_RANGES[variable]
    v = F.col(value)
    g = df.agg(F.count("*").alias("rows"), F.count_if(v.isNull()).alias("__missing"), F.count_if(v < lo).alias("below"), F.count_if(v > hi).alias("above"), F.bool_and(valid_lat(F.col("lat")) & valid_lon(F.col("lon"))).alias("coordinates_ok"))
    share = 100.0 * F.col("__missing") / F.nullif(F.col("rows"), F.lit(0))
    return g.select("rows", share.alias("missing_percent"), "below", "above", ((F.col("below") == 0) & (F.col("above") == 0)).alias("values_ok"), (share <= 50).alias("missing_ok"), "coordinates_ok")


def coordinate_checks(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """One row: ranges and mean spacing of the distinct coordinates, and whether they make sense."""
    g = df.agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"), F.count_distinct(lat).alias("n_lat"), F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"), F.count_distinct(lon).alias("n_lon"))
    step_lat = (F.col("lat_max") - F.col("lat_min")) / F.nullif(F.col("n_lat") - 1, F.lit(0))
    step_lon = (F.col("lon_max") - F.col("lon_min")) / F.nullif(F.col("n_lon") - 1, F.lit(0))
    ok = (F.col("lat_min") >= -90) & (F.col("lat_max") <= 90) & (((F.col("lon_min") >= -180) & (F.col("lon_max") <= 180)) | ((F.col("lon_min") >= 0) & (F.col("lon_max") <= 360)))
    return g.withColumns({"step_lat": step_lat, "step_lon": step_lon}).withColumn("valid", ok & (F.col("step_lat") > 0) & (F.col("step_lon") > 0))


def within_bounds(key: str, lat: Column, lon: Column) -> Column:
    """A coordinate in -180..180 lies in the bounds that files of a region may have."""
    a, b, c, d = COORDINATE_BOUNDS[key]
    return expr.in_box(lat, lon, a, b, c, d)
