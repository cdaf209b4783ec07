"""Queries that write through the sinks and read back what was written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stratus.operators import metrics, quality
from stratus.plans.manifest import latest
from stratus.plans.quality_queries import ISSUES, T
from stratus.plans.registry import query
from stratus.plans.summary_queries import LATEST, events
from stratus.plans.testbed import COUNTY_YEAR, OBS, county_year, obs
from stratus.schema import nan_to_null
from stratus.sources import catalog, sinks


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which executors share; only local masters may do without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{base or tempfile.mkdtemp(prefix='stratus-')}/written-{uuid.uuid4().hex}"


@query("variable:s region:s period_type:s target_year:i county:s value:d", """select 'tas' "variable", region, scenario period_type, "year" target_year, county, avg(tas) + case when "year" = 1998 then 1 else 0 end "value" from obs group by region, scenario, "year", county""", OBS)
def normals_written(spark, sf_dir):
    """K1, K2: a table by partition, of which one year's partitions are written again with other values."""
    rows = obs(spark, sf_dir).groupBy("region", F.col("scenario").alias("period_type"), F.col("year").alias("target_year"), "county").agg(F.avg("tas").alias("value")).withColumn("variable", F.lit("tas"))
    path = scratch(spark)
    sinks.write_normals(rows, path)
    sinks.write_normals(rows.where("target_year = 1998").withColumn("value", F.col("value") + 1), path)
    return spark.read.parquet(path)


@query("geoid:s year:i scenario:s mean_temp_c:d annual_precip_mm:d precip_gt_50mm:d pixel_count:i", 'select * from county_year', COUNTY_YEAR)
def county_csv(spark, sf_dir):
    """The county table as CSV and back, with leading zeros and missing values."""
    path = scratch(spark)
    sinks.write_county_csv(county_year(spark, sf_dir), path)
    return catalog.validation_csv(spark, path)


@query("severity:s message:s details:i", "select severity, message, 1 details from found where hit", ISSUES)
def issues_written(spark, sf_dir):
    """K6: issues as JSON lines, read back."""
    path = scratch(spark)
    sinks.write_issues(quality.issues(county_year(spark, sf_dir), T), path)
    found = spark.read.schema("validator string, severity string, category string, message string, details map<string,string>").json(path)
    return found.withColumn("details", (F.size("details") > 0).cast("int"))


@query("stage:s region:s variable:s scenario:s status:s", "select * exclude (n) from latest", LATEST)
def tasks_written(spark, sf_dir):
    """K8: the status table of the manifest as CSV, read back."""
    path = scratch(spark)
    sinks.write_tasks(latest(events(spark, sf_dir)), path, "csv")
    return spark.read.csv(path, header=True)


@query("geoid:s year:i num_grid_points:i mean:d std:d min:d max:d", 'select geoid, "year", count(tas) num_grid_points, avg(tas) mean, stddev_pop(tas) std, min(tas) min, max(tas) max from obs group by all', OBS)
def box_csv(spark, sf_dir):
    """K5: box statistics as CSV, read back."""
    path = scratch(spark)
    sinks.write_box_csv(metrics.box_statistics(obs(spark, sf_dir), "tas", ("geoid", "year")), path)
    return spark.read.csv(path, header=True)


@query("county:s readings:i valid:i mean:d", """select county, count(*) readings, count(v) valid, avg(v) mean from (select county, case when cell_id % 7 <> 0 or doy % 3 <> 0 then tas end as v from obs) group by county""", OBS)
def valid_readings(spark, sf_dir):
    """values that are no number don't count."""
    marked = F.when((F.col("cell_id") % 7 == 0) & (F.col("doy") % 3 == 0), float("nan")).otherwise(F.col("tas").cast("double")).alias("v")
    rows = nan_to_null(obs(spark, sf_dir).select("county", marked))
    return rows.groupBy("county").agg(F.count("*").alias("readings"), F.count("v").alias("valid"), F.avg("v").alias("mean"))


_PLACED = """select level, "variable", region, "rows", total from (select 'L1_means' as level, 'tas' as "variable", region, count(*) "rows", sum(tas) total from obs group by region union all select 'L2_metrics', 'tas', region, count(*), sum(tas - 273.15) from obs group by region)"""


@query("level:s variable:s region:s rows:i total:d", _PLACED, OBS)
def organized_outputs(spark, sf_dir):
    """K3, K9: tables at their organised places by level, variable and region, found again by their paths."""
    base = scratch(spark)
    rows = obs(spark, sf_dir).withColumn("variable", F.lit("tas"))
    for level, value in (("L1", F.col("tas")), ("L2", F.col("tas") - 273.15)):
        sinks.write_normals(rows.select("variable", "region", value.alias("value")), sinks.output_path(base, level, "noresm2", name="tas_NorESM2-LM_all"), ("variable", "region"))
    found = spark.read.option("recursiveFileLookup", "true").parquet(base).select("value", F.input_file_name().alias("path"))
    parts = {"level": r"/(L\d_\w+)/noresm2/tas_NorESM2-LM_all/", "variable": r"/variable=(\w+)/", "region": r"/region=([^/]+)/"}
    placed = found.select("value", *[F.url_decode(F.regexp_extract("path", p, 1)).alias(c) for c, p in parts.items()])
    return placed.groupBy("level", "variable", "region").agg(F.count("*").alias("rows"), F.sum("value").alias("total"))
