"""Daily climatologies, trailing-window normals and the plans of windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.functions import expr
from stratus.regions import Region, model

WINDOW = 30
#: Up to so many years a window's readings are sent to its targets one by one, which is quicker than the sort that running sums need.
SHORT_WINDOW = 10
MIN_YEARS = 25
HISTORICAL_END = 2014


def region_box(df: DataFrame, r: Region, is_360: bool = True, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows inside a region; on Parquet the latitude bounds reach the scan."""
    return df.where(expr.in_region(F.col(lat), F.col(lon), r, is_360))


def latest_versions(files: DataFrame, keys: tuple[str, ...] = ("variable", "scenario", "year")) -> DataFrame:
    """The highest version of each file; versions compare by their numeric parts, none is lowest."""
    parts = F.transform(F.split(F.coalesce(F.col("version"), F.lit("0")), r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)))
    w = Window.partitionBy(*keys).orderBy(parts.desc(), F.col("path"))
    return files.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def with_cell(df: DataFrame) -> DataFrame:
    """Adds cell, a long that stands for lat and lon to a millionth of a degree: a cheap key that also keeps its partitioning, which
    floating-point grouping keys don't."""
    y, x = F.round((F.col("lat") + 90) * 1e6).cast("bigint"), F.round((F.col("lon") + 180) * 1e6).cast("bigint")
    return df.withColumn("cell", F.shiftleft(y, 30) + x)


def _cell_means(df: DataFrame, value: str, *keys: str) -> DataFrame:
    g = df.groupBy(*keys, "doy", "cell").agg(F.first("lat").alias("lat"), F.first("lon").alias("lon"), F.avg(value).alias("value"))
    return g.select(*keys, "doy", "cell", "lat", "lon", "value")


def daily_climatology(df: DataFrame, value: str = "value", keys: tuple[str, ...] = ("variable", "scenario", "year"), mode: str = "standard") -> DataFrame:
    """Mean by cell and day of each year: keys, doy, cell, lat, lon, value. standard: 365 days, day 60 of leap years dropped; calendar: days
    as they are.

    The rows are shuffled once, by day and cell. A reading a day leaves nothing for partial sums to save, and every later mean over years,
    scenarios or windows of the same day and cell finds its rows in place, so the exploded windows are never shuffled.
    """
    if mode not in ("standard", "calendar"):
        raise ValueError(f"unknown mode {mode}")
    days = with_cell(expr.leap_365(df) if mode == "standard" else df)
    return _cell_means(days.select(*keys, "doy", "cell", "lat", "lon", value).repartition("doy", "cell"), value, *keys)


def mean_over(daily: DataFrame, *keys: str) -> DataFrame:
    """The mean of daily climatologies by the keys that are left, day and cell."""
    return _cell_means(daily, "value", *keys)


def exploded_targets(df: DataFrame, window: int = WINDOW, first: int | None = None, last: int | None = None) -> DataFrame:
    """Each row goes to every target year whose trailing window holds its year: an equi-key in place of a range join."""
    start, end = F.col("year"), F.col("year") + (window - 1)
    if first is not None:
        start = F.greatest(start, F.lit(first))
    if last is not None:
        end = F.least(end, F.lit(last))
    return df.where(start <= end).withColumn("target_year", F.explode(F.sequence(start, end)))


def window_means(daily: DataFrame, frames: DataFrame, series: tuple[str, ...], by: tuple[str, ...], longest: int) -> DataFrame:
    """Mean of each frame of years by day and cell: by, doy, cell, lat, lon, value.

    frames has first_year, last_year (at most `longest` years) and what tells frames and series apart; it is small and broadcast. Readings are added up along
    their series once. A frame's sum is what has been added up by its last year less what had been before its first, so a reading
    makes a row for each frame that ends, or begins, between it and its series' next reading, not one for each frame that holds it.
    Values that are not finite are counted, not added up, so that they tell in the frames that hold them alone, as in a plain mean.
    """
    of = [c for c in series if c in frames.columns]
    ends = frames.withColumns({"year": F.col("last_year"), "__sign": F.lit(1)}).unionByName(frames.withColumns({"year": F.col("first_year") - 1, "__sign": F.lit(-1)})).drop("first_year", "last_year")
    so_far = Window.partitionBy(*series, "doy", "cell").orderBy("year")
    v = F.col("value").cast("double")
    odd = {"__up": v == float("inf"), "__down": v == -float("inf"), "__nan": F.isnan(v)}
    added = daily.select(
        *series, "year", "doy", "cell", "lat", "lon", *[F.count_if(c).over(so_far).alias(n) for n, c in odd.items()],
        F.sum(F.when(F.abs(v) < float("inf"), F.col("value"))).over(so_far).alias("__sum"), F.count("value").over(so_far).alias("__n"), F.count(F.lit(1)).over(so_far).alias("__rows"), F.coalesce(F.lead("year").over(so_far) - 1, F.col("year") + (longest - 1)).alias("__until"),
    )
    held = added.where(F.col("year") <= F.col("__until")).withColumn("year", F.explode(F.sequence("year", "__until")))
    parts = held.join(F.broadcast(ends), [*of, "year"]).groupBy(*by, "doy", "cell")
    sums = [F.sum(F.col("__sign") * F.coalesce(c, F.lit(0))).alias(c) for c in ("__sum", "__n", "__rows", *odd)]
    g = parts.agg(F.first("lat").alias("lat"), F.first("lon").alias("lon"), *sums).where("__rows > 0")
    mean = F.when((F.col("__nan") > 0) | ((F.col("__up") > 0) & (F.col("__down") > 0)), float("nan")).when(F.col("__up") > 0, float("inf")).when(F.col("__down") > 0, -float("inf")).when(F.col("__n") > 0, F.col("__sum") / F.col("__n"))
    return g.select(*by, "doy", "cell", "lat", "lon", mean.alias("value"))


def climate_normal(daily: DataFrame, window: int = WINDOW, min_years: int = MIN_YEARS, keys: tuple[str, ...] = ("variable",), first: int | None = None, last: int | None = None, readings: DataFrame | None = None) -> DataFrame:
    """Mean over the years of each trailing window, every year weighing the same, where at least min_years hold data.

    The year count is a property of the window, so it comes from the distinct (keys, year) pairs, a few rows, and not from a
    distinct count over cells and days. The pairs are taken from `readings` where the rows that daily was made of are at hand, which
    spares the daily aggregation a second time.
    """
    pairs = (daily if readings is None else readings).select(*keys, "year").distinct()
    years = exploded_targets(pairs, window, first, last)
    enough = years.groupBy(*keys, "target_year").agg(F.count("*").alias("num_years"), F.min("year").alias("source_start"), F.max("year").alias("source_end")).where(F.col("num_years") >= min_years)
    if window <= SHORT_WINDOW:
        means = _cell_means(exploded_targets(daily, window, first, last), "value", *keys, "target_year")
    else:
        frames = enough.select(*keys, "target_year", (F.col("target_year") - (window - 1)).alias("first_year"), F.col("target_year").alias("last_year"))
        means = window_means(daily, frames, keys, (*keys, "target_year"), window)
    return means.join(F.broadcast(enough), [*keys, "target_year"])


def hybrid_rows(df: DataFrame, hist_end: int = HISTORICAL_END, projection: str = "ssp245") -> DataFrame:
    """Historical up to the cut year, the projection after it."""
    historical = (F.col("scenario") == "historical") & (F.col("year") <= hist_end)
    return df.where(historical | ((F.col("scenario") == projection) & (F.col("year") > hist_end)))


def hybrid_sources(files: DataFrame, targets: DataFrame, window: int = WINDOW, order: tuple[str, ...] = ("historical", "ssp245")) -> DataFrame:
    """target_year, scenario, files: for each year of each trailing window the first scenario that has a file.

    targets holds target_year; it is a small list of years.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("scenario"))
    best = files.where(F.col("scenario").isin(*order)).groupBy("year").agg(F.min_by("scenario", rank).alias("scenario"))
    wanted = targets.select("target_year", F.explode(F.sequence(F.col("target_year") - (window - 1), F.col("target_year"))).alias("year"))
    return wanted.join(best, "year").groupBy("target_year", "scenario").agg(F.count("*").alias("files"))


def climatology_of_period(df: DataFrame, value: str = "value", keys: tuple[str, ...] = ("variable",)) -> DataFrame:
    """One mean over all days by cell."""
    return df.groupBy(*keys, "lat", "lon").agg(F.avg(value).alias("value"))


def period_plan(spark: SparkSession, name: str = "NorESM2-LM", window: int = WINDOW) -> DataFrame:
    """scenario, period_type, target_year, start_year, end_year of every normal of a model.

    historical: 1980..2014, hybrid: 2015..2044 (windows over the cut), projections: 2045..2100.
    """
    plans = [("historical", "historical", 1980, HISTORICAL_END)]
    plans += [(s, "hybrid", HISTORICAL_END + 1, HISTORICAL_END + window) for s in model(name).scenarios if s != "historical"]
    plans += [(s, s, HISTORICAL_END + window + 1, 2100) for s in model(name).scenarios if s != "historical"]
    frame = spark.createDataFrame(plans, "scenario string, period_type string, a int, b int")
    targets = frame.select("scenario", "period_type", F.explode(F.sequence("a", "b")).alias("target_year"))
    start = F.when(F.col("period_type") == "historical", F.greatest(F.lit(1950), F.col("target_year") - (window - 1))).otherwise(F.col("target_year") - (window - 1))
    return targets.select("scenario", "period_type", "target_year", start.alias("start_year"), F.col("target_year").alias("end_year"))


def frame_source(period_type: Column, year: Column, hist_end: int = HISTORICAL_END) -> Column:
    """Whether a year of a window is read from historical files."""
    return (period_type == "historical") | ((period_type == "hybrid") & (year <= hist_end))


def normals_from_plan(daily: DataFrame, plan: DataFrame, min_years: int = MIN_YEARS, hist_end: int = HISTORICAL_END, readings: DataFrame | None = None) -> DataFrame:
    """Normals of all planned windows in one pass; daily has variable, scenario, year, doy, cell, lat, lon, value.

    The plan has a few hundred rows; one number of it, its longest window, comes to the driver. It is broadcast by source scenario.
    """
    years = plan.select("scenario", "period_type", "target_year", F.explode(F.sequence("start_year", "end_year")).alias("year"))
    source = F.when(frame_source(F.col("period_type"), F.col("year"), hist_end), "historical").otherwise(F.col("scenario"))
    pairs = years.select(F.col("scenario").alias("plan_scenario"), "period_type", "target_year", "year", source.alias("scenario"))
    present = (daily if readings is None else readings).select("variable", "scenario", "year").distinct().join(F.broadcast(pairs), ["scenario", "year"])
    keys = ["variable", "plan_scenario", "period_type", "target_year"]
    enough = present.groupBy(*keys).agg(F.count_distinct("year").alias("num_years"), F.min("year").alias("source_start"), F.max("year").alias("source_end")).where(F.col("num_years") >= min_years)
    longest = plan.agg(F.max(F.col("end_year") - F.col("start_year") + 1)).first()[0] or 0
    if longest <= SHORT_WINDOW:
        means = _cell_means(daily.join(F.broadcast(pairs), ["scenario", "year"]), "value", *keys)
    else:
        # The years of a window that come from one scenario follow each other.
        frames = pairs.groupBy("scenario", *keys[1:]).agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))
        means = window_means(daily, frames, ("variable", "scenario"), tuple(keys), longest)
    return means.join(F.broadcast(enough), keys).withColumnRenamed("plan_scenario", "scenario")
