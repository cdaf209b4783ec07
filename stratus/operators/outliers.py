"""Outlying counties by three methods over the long table (geoid, year, scenario, metric, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import expr
from stratus.operators.quality import DEFAULT, Thresholds, issue


def iqr_rows(long: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Rows outside the quartile fences of their (metric, scenario, year)."""
    keys = ["metric", "scenario", "year"]
    fences = long.groupBy(*keys).agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    fences = fences.select(*keys, (F.col("q")[0] - t.iqr * (F.col("q")[1] - F.col("q")[0])).alias("low"), (F.col("q")[1] + t.iqr * (F.col("q")[1] - F.col("q")[0])).alias("high"))
    return long.join(fences, keys).where((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))


def iqr(long: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """metric, scenario, geoid, hits of counties flagged in more than the share of the scenario's years."""
    years = long.groupBy("scenario").agg(F.count_distinct("year").alias("years"))
    hits = iqr_rows(long, t).groupBy("metric", "scenario", "geoid").agg(F.count("*").alias("hits"))
    return hits.join(years, "scenario").where(F.col("hits") > t.year_share * F.col("years")).select("metric", "scenario", "geoid", "hits")


def zscore(long: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """metric, scenario, geoid, hits of counties with more than the allowed hits."""
    keys = ["metric", "scenario"]
    s = long.groupBy(*keys).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("dev")).where("dev > 0")
    flagged = long.join(s, keys).where(F.abs(F.col("value") - F.col("mean")) > t.z * F.col("dev"))
    return flagged.groupBy(*keys, "geoid").agg(F.count("*").alias("hits")).where(F.col("hits") > t.repeated)


def modified_zscore(long: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """The same with median and median absolute deviation; groups whose deviation is 0 flag nothing, NULLs don't count."""
    keys = ["metric", "scenario"]
    middle = long.groupBy(*keys).agg(F.median("value").alias("m"))
    off = long.join(middle, keys).withColumn("off", F.abs(F.col("value") - F.col("m")))
    mad = off.groupBy(*keys).agg(F.median("off").alias("mad")).where("mad > 0")
    flagged = off.join(mad, keys).where(0.6745 * F.col("off") > t.modified_z * F.col("mad"))
    return flagged.groupBy(*keys, "geoid").agg(F.count("*").alias("hits")).where(F.col("hits") > t.repeated)


def all_methods(long: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """method, metric, scenario, geoid, hits: what the three methods find, from the fences by year, the statistics by scenario and one count.

    The statistics have a row for each metric, scenario and year; rows meet them and are counted once for all methods.
    """
    keys, c = ["metric", "scenario"], F.col
    fences = long.groupBy(*keys, "year").agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    fences = fences.select(*keys, "year", (c("q")[0] - t.iqr * (c("q")[1] - c("q")[0])).alias("low"), (c("q")[1] + t.iqr * (c("q")[1] - c("q")[0])).alias("high"))
    years = fences.groupBy("scenario").agg(F.count_distinct("year").alias("years"))
    s = long.groupBy(*keys).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("dev"), F.median("value").alias("m"))
    mad = long.join(s.select(*keys, "m"), keys).groupBy(*keys).agg(F.median(F.abs(c("value") - c("m"))).alias("mad"))
    rows = long.join(fences, [*keys, "year"]).join(s.join(mad, keys), keys)
    flags = {"iqr": (c("value") < c("low")) | (c("value") > c("high")), "zscore": (c("dev") > 0) & (F.abs(c("value") - c("mean")) > t.z * c("dev")), "modified_zscore": (c("mad") > 0) & (0.6745 * F.abs(c("value") - c("m")) > t.modified_z * c("mad"))}
    hits = rows.groupBy(*keys, "geoid").agg(*[F.count_if(f).alias(name) for name, f in flags.items()]).join(years, "scenario")
    return hits.unpivot([*keys, "geoid", "years"], list(flags), "method", "hits").where(F.when(c("method") == "iqr", c("hits") > t.year_share * c("years")).otherwise(c("hits") > t.repeated)).select("method", *keys, "geoid", "hits")


def persistent(found: DataFrame, times: int = 3) -> DataFrame:
    """geoid, detections of counties found at least so often over all methods, metrics and scenarios."""
    return found.groupBy("geoid").agg(F.count("*").alias("detections")).where(F.col("detections") >= times)


def by_state(persistent_counties: DataFrame, counties: DataFrame | None = None) -> DataFrame:
    """state, counties; with a county table only counties that it holds."""
    kept = persistent_counties if counties is None else persistent_counties.join(counties.select("geoid"), "geoid", "left_semi")
    return kept.groupBy(expr.state_of(F.col("geoid")).alias("state")).agg(F.count("*").alias("counties"))


def findings(found: DataFrame) -> DataFrame:
    """method, metrics, detections."""
    return found.groupBy("method").agg(F.count_distinct("metric").alias("metrics"), F.count("*").alias("detections"))


def top_counties(long: DataFrame, t: Thresholds = DEFAULT, top: int = 5) -> DataFrame:
    """metric, geoid, hits, rank: the counties most often outside the fences; ties by geoid."""
    hits = iqr_rows(long, t).groupBy("metric", "geoid").agg(F.count("*").alias("hits"))
    w = Window.partitionBy("metric").orderBy(F.desc("hits"), "geoid")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def issues(long: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Issues of the spatial outlier validator."""
    found = all_methods(long, t)
    many = persistent(found).agg(F.count("*").alias("n"))
    return issue(findings(found), "spatial_outliers", "INFO", "Spatial Outliers", F.concat(F.col("method"), F.lit(" outliers")), F.col("detections") > 0, metrics=F.col("metrics"), detections=F.col("detections")).unionByName(
        issue(many, "spatial_outliers", "WARNING", "Spatial Outliers", F.lit("persistent outlier counties"), F.col("n") > 0, counties=F.col("n"))
    )
