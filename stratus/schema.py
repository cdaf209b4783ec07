"""Table schemas and ingest rules. Column names are the same from one level to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRID_DAILY = "variable string, scenario string, year int, doy int, lat double, lon double, value double"
NORMALS = "variable string, region string, period_type string, target_year int, doy int, lat double, lon double, value double, num_years bigint, source_start int, source_end int"
COUNTIES = "geoid string, name string, statefp string, region string, bbox struct<minx:double,miny:double,maxx:double,maxy:double>, rings array<array<struct<lon:double,lat:double>>>, centroid_lon double, centroid_lat double"
CELL_COUNTY = "geoid string, lat double, lon double, is_nearest boolean"
COUNTY_METRICS = "geoid string, year int, scenario string, region string, variable string, metric string, value double, threshold double, pixel_count bigint"
COUNTY_YEAR = "geoid string, year int, scenario string, mean_temp_c double, min_temp_c double, max_temp_c double, annual_precip_mm double, precip_gt_50mm double, precip_gt_100mm double, pixel_count bigint"
ISSUES = "validator string, severity string, category string, message string, details map<string,string>"
TASKS = "task_id string, stage string, region string, variable string, scenario string, status string, start_time timestamp, end_time timestamp, input_files array<string>, output_files array<string>, error_message string"

#: Names that other producers use for the columns above.
RENAMES = {"annual_mean_temp_c": "mean_temp_c", "annual_min_temp_c": "min_temp_c", "annual_max_temp_c": "max_temp_c", "annual_precipitation_mm": "annual_precip_mm", "GEOID": "geoid", "fips": "geoid", "NAME": "name", "STATEFP": "statefp"}


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column: Spark orders NaN above all numbers and keeps it in averages."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats}) if floats else df


def standard_names(df: DataFrame) -> DataFrame:
    """Rename known variants; a variant beside its standard column stays as it is."""
    present = set(df.columns)
    return df.withColumnsRenamed({a: b for a, b in RENAMES.items() if a in present and b not in present})


def with_geoid(df: DataFrame, column: str = "geoid") -> DataFrame:
    """Five characters with leading zeros, as a string."""
    return df.withColumn(column, F.lpad(F.col(column).cast("string"), 5, "0"))
