"""Summaries of county, grid and task tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import expr
from stratus.operators.metrics import exact_quantiles


def region_summary(df: DataFrame, metric: str) -> DataFrame:
    """One row: records, distinct counties, share of rows with the metric."""
    return df.agg(F.count("*").alias("records"), F.count_distinct("geoid").alias("counties"), (100.0 * F.count(metric) / F.nullif(F.count("*"), F.lit(0))).alias("coverage"))


def rows_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))


def period_mean(df: DataFrame, metric: str, first: int, last: int, scenario: str | None = None) -> DataFrame:
    """geoid, mean over the years of a period."""
    kept = df.where(F.col("year").between(first, last))
    return (kept.where(F.col("scenario") == scenario) if scenario else kept).groupBy("geoid").agg(F.avg(metric).alias("mean"))


def scenario_change(df: DataFrame, metric: str, scenario: str, future: tuple[int, int] = (2050, 2080), past: tuple[int, int] = (1980, 2014)) -> DataFrame:
    """geoid, historical, future, change in one pass; NULL where a side is absent."""
    f = F.avg(F.when((F.col("scenario") == scenario) & F.col("year").between(*future), F.col(metric)))
    h = F.avg(F.when((F.col("scenario") == "historical") & F.col("year").between(*past), F.col(metric)))
    either = ((F.col("scenario") == scenario) & F.col("year").between(*future)) | ((F.col("scenario") == "historical") & F.col("year").between(*past))
    return df.where(either).groupBy("geoid").agg(h.alias("historical"), f.alias("future")).withColumn("change", F.col("future") - F.col("historical"))


def completeness(df: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """geoid, completeness in percent over the metrics, distinct years."""
    share = sum((F.col(m).isNotNull().cast("double") for m in metrics), F.lit(0.0)) / len(metrics)
    return df.groupBy("geoid").agg((100 * F.avg(share)).alias("completeness"), F.count_distinct("year").alias("years"))


def year_by_scenario(df: DataFrame, metric: str, scenarios: tuple[str, ...]) -> DataFrame:
    """year and a column of means for each scenario named."""
    return df.groupBy("year").pivot("scenario", list(scenarios)).agg(F.avg(metric))


def correlations(df: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """a, b, corr of each pair of metrics over the rows that hold both, in one pass."""
    pairs = [(a, b) for i, a in enumerate(metrics) for b in metrics[i + 1 :]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
    return long.select(F.split("pair", r"\|")[0].alias("a"), F.split("pair", r"\|")[1].alias("b"), "corr")


def trend(df: DataFrame, y: str, x: str = "year", keys: tuple[str, ...] = ()) -> DataFrame:
    """Slope and intercept of the least-squares line."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """bin (from 0), low, n of equal-width bins, the last one closed; bins without rows are left out."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col(column) - F.col("lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)))
    rows = df.where(F.col(column).isNotNull()).select(column, bounds.alias("b")).select(column, "b.lo", "b.hi")
    return rows.groupBy(at.cast("int").alias("bin"), "lo", "hi").agg(F.count("*").alias("n")).select("bin", (F.col("lo") + F.col("bin") * width).alias("low"), "n")


def quartiles(df: DataFrame, column: str, by: Column, name: str) -> DataFrame:
    """Quartiles, least, greatest and count by group."""
    g = df.groupBy(by.alias(name)).agg(F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.min(column).alias("min"), F.max(column).alias("max"), F.count(column).alias("n"))
    return g.select(name, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "min", "max", "n")


def spatial_mean(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Unweighted mean over cells by day, year or both."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"))


def seasonal_means(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Mean by season and keys."""
    return df.groupBy(expr.season(F.col("doy")).alias("season"), *keys).agg(F.avg(value).alias("mean"))


def display_season_means(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Mean by display season; a day that two of them hold counts in both."""
    return df.withColumn("season", F.explode(expr.display_seasons(F.col("doy")))).groupBy("season", *keys).agg(F.avg(value).alias("mean"))


def state_means(df: DataFrame, metric: str, at_least: int = 5, top: int = 10) -> DataFrame:
    """state, mean, n of states with enough values, the first ones by code."""
    g = df.groupBy(expr.state_of(F.col("geoid")).alias("state")).agg(F.avg(metric).alias("mean"), F.count(metric).alias("n"))
    return g.where(F.col("n") >= at_least).orderBy("state").limit(top)


def describe(df: DataFrame, column: str, *keys: str, population: bool = False) -> DataFrame:
    """Count, mean, deviation (sample, or population), quartiles, least and greatest.

    By keys the quartiles of a group are taken in one task, so groups must be bounded, as those of county tables are. Without keys they
    come from exact_quantiles(), which runs its passes at once and suits a table of any size.
    """
    dev = F.stddev_pop(column) if population else F.stddev_samp(column)
    if not keys:
        cuts = exact_quantiles(df, {"q1": (column, 0.25), "median": (column, 0.5), "q3": (column, 0.75)})
        middle = [F.lit(v).cast("double").alias(k) for k, v in cuts.items()]
        return df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), dev.alias("std"), F.min(column).alias("min"), *middle, F.max(column).alias("max"))
    g = df.groupBy(*keys).agg(F.count(column).alias("n"), F.avg(column).alias("mean"), dev.alias("std"), F.min(column).alias("min"), F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.max(column).alias("max"))
    return g.select(*keys, "n", "mean", "std", "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max")


def coverage(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """Rows with and without a value."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.count(column).alias("with_data"), F.count_if(F.col(column).isNull()).alias("without_data"))


def task_status(tasks: DataFrame) -> DataFrame:
    """dimension, key, total, completed, failed, rate: by stage, region, variable and overall, in one aggregation."""
    done, lost = F.count_if(F.col("status") == "completed"), F.count_if(F.col("status") == "failed")
    g = tasks.groupingSets([[F.col("stage")], [F.col("region")], [F.col("variable")], []], "stage", "region", "variable").agg(F.grouping_id().alias("g"), F.count("*").alias("total"), done.alias("completed"), lost.alias("failed"))
    dimension = F.when(F.col("g") == 3, "stage").when(F.col("g") == 5, "region").when(F.col("g") == 6, "variable").otherwise("overall")
    key = F.when(F.col("g") == 3, F.col("stage")).when(F.col("g") == 5, F.col("region")).when(F.col("g") == 6, F.col("variable")).otherwise("all")
    return g.select(dimension.alias("dimension"), key.alias("key"), "total", "completed", "failed", (100.0 * F.col("completed") / F.col("total")).alias("rate"))


def status_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("status").agg(F.count("*").alias("tasks"))


def run_summary(tasks: DataFrame) -> DataFrame:
    """One row: total, completed, failed, success rate and mean seconds; seconds is a column."""
    done, lost = F.count_if(F.col("status") == "completed"), F.count_if(F.col("status") == "failed")
    return tasks.agg(F.count("*").alias("total"), done.alias("completed"), lost.alias("failed"), (100.0 * done / F.nullif(F.count("*"), F.lit(0))).alias("success_rate"), F.avg("seconds").alias("mean_seconds"), (F.count("*") / F.nullif(F.sum("seconds"), F.lit(0.0))).alias("throughput"))


def speedup(runs: DataFrame) -> DataFrame:
    """workers, seconds, speedup, efficiency against the row of one worker."""
    g = runs.withColumn("__one", runs.where("workers = 1").agg(F.min("seconds")).scalar())
    return g.select("workers", "seconds", (F.col("__one") / F.col("seconds")).alias("speedup"), (F.col("__one") / F.col("seconds") / F.col("workers")).alias("efficiency"))


def year_coverage(files: DataFrame, first: int, last: int, *keys: str) -> DataFrame:
    """Keys, found, missing (sorted array), percent of the expected years."""
    expected = F.sequence(F.lit(first), F.lit(last))
    g = files.where(F.col("year").between(first, last)).groupBy(*keys).agg(F.collect_set("year").alias("y"))
    return g.select(*keys, F.size("y").cast("bigint").alias("found"), F.sort_array(F.array_except(expected, "y")).alias("missing"), (100.0 * F.size("y") / (last - first + 1)).alias("percent"))


def missing_share(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """column, percent missing, most first; ties by name."""
    from stratus.operators.quality import missing_percent

    return missing_percent(df, list(columns)).orderBy(F.desc("percent"), "column")
