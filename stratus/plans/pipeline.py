"""Pipelines: a stage is a function of its inputs' DataFrames that returns a DataFrame, written once and read back.

run() goes through the stages in the order of their dependencies; tables are its state. Spark schedules, and repeats lost or failed tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratus.plans.config import Pipeline, Stage

Builder = Callable[[SparkSession, Stage, dict[str, DataFrame]], DataFrame]


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was committed below a path, in any file system that Spark knows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def run(spark: SparkSession, pipeline: Pipeline, handlers: dict[str, Builder], resume: bool = False) -> dict[str, str]:
    """The path of each stage's table. handlers maps a stage's id, or its type, to the function that builds its result.

    resume takes tables that are there as they are. A failure is raised; where the pipeline continues on failure, the stages that don't need the
    failed one are still made and the first failure is raised at the end, so that a second call with resume does what is left.
    """
    missing = [s.id for s in pipeline.stages if s.id not in handlers and s.type not in handlers]
    if missing:
        raise ValueError(f"no handler for {missing}")
    paths: dict[str, str] = {}
    failure: Exception | None = None
    for stage in (pipeline.stage(id_) for level in pipeline.levels() for id_ in level):
        path = f"{pipeline.base_path.rstrip('/')}/{stage.id}"
        if any(d not in paths for d in stage.depends_on):
            continue
        if not (resume and is_written(spark, path)):
            inputs = {d: spark.read.parquet(paths[d]) for d in (*stage.depends_on, *stage.optional_inputs) if d in paths}
            try:
                (handlers.get(stage.id) or handlers[stage.type])(spark, stage, inputs).write.mode("overwrite").parquet(path)
            except Exception as error:
                if not pipeline.continue_on_stage_failure:
                    raise
                failure = failure or error
                continue
        paths[stage.id] = path
    if failure:
        raise failure
    return paths


def means_stage(spark: SparkSession, stage: Stage, inputs: dict[str, DataFrame]) -> DataFrame:
    """Normals from daily readings below options.input, by the plan of a model or with trailing windows."""
    from stratus.functions.expr import leap_365
    from stratus.operators import climatology
    from stratus.regions import region

    o = stage.options
    days = spark.read.parquet(o["input"])
    if "region" in o:
        days = climatology.region_box(days, region(o["region"]), o.get("is_360", True))
    mode = o.get("days", "standard")
    daily = climatology.daily_climatology(days, "value", ("variable", "scenario", "year"), mode)
    readings = leap_365(days) if mode == "standard" else days
    if "model" in o:
        return climatology.normals_from_plan(daily, climatology.period_plan(spark, o["model"]), o.get("min_years", climatology.MIN_YEARS), readings=readings)
    return climatology.climate_normal(daily, o.get("window", climatology.WINDOW), o.get("min_years", climatology.MIN_YEARS), ("variable", "scenario"), readings=readings)


def metrics_stage(spark: SparkSession, stage: Stage, inputs: dict[str, DataFrame]) -> DataFrame:
    """County metrics of each variable's normals, in long form; options.cell_county has (geoid, lat, lon)."""
    from functools import reduce

    from pyspark.sql import functions as F

    from stratus.functions.expr import KELVIN, SECONDS_A_DAY
    from stratus.operators import metrics

    normals = next(iter(inputs.values()))
    pairs = spark.read.parquet(stage.options["cell_county"]).select("geoid", "lat", "lon")
    parts = []
    for variable in stage.options.get("variables", ("tas",)):
        names = metrics.available(variable)
        converted = F.col("value") * SECONDS_A_DAY if variable == "pr" else F.col("value") - KELVIN
        days = normals.where(F.col("variable") == variable).select("scenario", F.col("target_year").alias("year"), "lat", "lon", converted.alias(variable))
        cells = metrics.cell_metrics(days, names, ("scenario", "year", "lat", "lon")).join(pairs, ["lat", "lon"])
        parts.append(metrics.county_metrics(cells, names, ("geoid", "year", "scenario")))
    return reduce(DataFrame.unionByName, parts)


def validation_stage(spark: SparkSession, stage: Stage, inputs: dict[str, DataFrame]) -> DataFrame:
    """Issues of the validators that options.validators names, over the wide county table of the long metrics."""
    from functools import reduce

    from pyspark.sql import functions as F

    from stratus.operators import outliers, quality
    from stratus.plans.config import VALIDATORS

    long = next(iter(inputs.values()))
    wide = long.groupBy("geoid", "year", "scenario").pivot("metric", list(quality.METRIC_COLUMNS)).agg(F.first("value"))
    limits = quality.DEFAULT.with_limits(**stage.options.get("thresholds", {}))
    checks = {"qaqc": lambda: quality.issues(wide, limits), "spatial_outliers": lambda: outliers.issues(quality.long_form(wide), limits), "precipitation": lambda: quality.precipitation_issues(wide)}
    names = dict.fromkeys(VALIDATORS[v] for v in stage.options.get("validators", VALIDATORS))
    return reduce(DataFrame.unionByName, [checks[n]() for n in names])


HANDLERS: dict[str, Builder] = {"means": means_stage, "metrics": metrics_stage, "validation": validation_stage}
