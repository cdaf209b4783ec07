"""Checks over the county x year x scenario table. Each gives a table of its own; issues() folds them into one."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import expr


@dataclass(frozen=True)
class Thresholds:
    """Limits of the checks; replace() gives a region's own."""

    years: tuple[int, int] = (1980, 2100)
    scenarios: tuple[str, ...] = ("historical", "ssp245", "ssp585")
    expected_counties: int = 3109
    county_share: float = 0.95
    missing_percent: float = 10.0
    iqr: float = 1.5
    z: float = 3.0
    modified_z: float = 3.5
    repeated: int = 5
    year_share: float = 0.1
    temp_change: float = 5.0
    precip_change: float = 500.0
    monotonic_rows: int = 20
    tolerance: float = 0.1
    ranges: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(PLAUSIBLE))

    def with_limits(self, **limits) -> Thresholds:
        """The same limits with some replaced; an unknown name is an error."""
        return replace(self, **limits)


# Plausible ranges, inclusive.
PLAUSIBLE = {"mean_temp_c": (-40.0, 50.0), "min_temp_c": (-50.0, 40.0), "max_temp_c": (-30.0, 60.0), "annual_precip_mm": (0.0, 5000.0), "precip_gt_50mm": (0.0, 365.0), "precip_gt_100mm": (0.0, 365.0)}
DEFAULT = Thresholds()
# Limits that differ in Alaska.
ALASKA = DEFAULT.with_limits(iqr=2.0, z=3.5, modified_z=4.0, precip_change=800.0, expected_counties=30)

METRIC_COLUMNS = ("mean_temp_c", "min_temp_c", "max_temp_c", "annual_precip_mm", "precip_gt_50mm", "precip_gt_100mm")


def metric_columns(df: DataFrame, limit: int | None = None) -> list[str]:
    """The metric columns present, in table order, at most `limit`."""
    return [c for c in df.columns if c in METRIC_COLUMNS][:limit]


def long_form(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """geoid, year, scenario, metric, value."""
    columns = columns or metric_columns(df)
    return df.select("geoid", "year", "scenario", *[F.col(c).cast("double") for c in columns]).unpivot(["geoid", "year", "scenario"], columns, "metric", "value")


def missing_percent(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, missing, percent: one row each, in one pass."""
    columns = columns or df.columns
    one = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = one.unpivot(["rows"], columns, "column", "missing")
    return long.select("column", "missing", F.when(F.col("rows") > 0, 100.0 * F.col("missing") / F.col("rows")).otherwise(0.0).alias("percent"))


def duplicates(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each (geoid, year, scenario)."""
    counts = df.groupBy("geoid", "year", "scenario").agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def incomplete_series(df: DataFrame, t: Thresholds = DEFAULT, by_scenario: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """geoid, scenario, missing_years of series that lack years of the expected range (of all, or of their scenario)."""
    low, high = F.lit(t.years[0]), F.lit(t.years[1])
    for s, (a, b) in (by_scenario or {}).items():
        low, high = F.when(F.col("scenario") == s, a).otherwise(low), F.when(F.col("scenario") == s, b).otherwise(high)
    years = df.withColumns({"__a": low, "__b": high}).groupBy("geoid", "scenario", "__a", "__b").agg(F.count_distinct(F.when(F.col("year").between(F.col("__a"), F.col("__b")), F.col("year"))).alias("n"))
    return years.select("geoid", "scenario", (F.col("__b") - F.col("__a") + 1 - F.col("n")).alias("missing_years")).where("missing_years > 0")


def missing_scenarios(df: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """geoid, missing (sorted array) of counties that lack an expected scenario."""
    expected = F.array(*[F.lit(s) for s in t.scenarios])
    return df.groupBy("geoid").agg(F.collect_set("scenario").alias("s")).select("geoid", F.sort_array(F.array_except(expected, "s")).alias("missing")).where(F.size("missing") > 0)


def county_count(df: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """One row: counties, expected, too_few."""
    return df.agg(F.count_distinct("geoid").alias("counties")).select("counties", F.lit(t.expected_counties).alias("expected"), (F.col("counties") < t.county_share * t.expected_counties).alias("too_few"))


def _limit(metric: Column, t: Thresholds, deviation: Column) -> Column:
    return F.when(metric.contains("temp"), F.lit(t.temp_change)).when(metric.contains("precip"), F.lit(t.precip_change)).otherwise(3 * deviation)


def year_over_year(df: DataFrame, t: Thresholds = DEFAULT, limit: int | None = None) -> DataFrame:
    """geoid, scenario, metric, largest_change, changes of series with a change over the metric's limit; `limit` takes the first metrics only."""
    long = long_form(df, metric_columns(df, limit))
    w = Window.partitionBy("geoid", "scenario", "metric").orderBy("year")
    steps = long.withColumn("change", F.abs(F.col("value") - F.lag("value").over(w)))
    s = steps.groupBy("geoid", "scenario", "metric").agg(F.count("*").alias("rows"), F.stddev_samp("value").alias("dev"), F.max("change").alias("largest_change"), F.sort_array(F.collect_list("change")).alias("all"))
    s = s.where("rows >= 2").withColumn("limit", _limit(F.col("metric"), t, F.col("dev")))
    return s.withColumn("changes", F.size(F.filter("all", lambda c: c > F.col("limit"))).cast("bigint")).where("changes > 0").select("geoid", "scenario", "metric", "largest_change", "changes")


def monotonic(df: DataFrame, t: Thresholds = DEFAULT, columns: tuple[str, ...] = ("mean_temp_c", "min_temp_c", "max_temp_c")) -> DataFrame:
    """geoid, scenario, metric, direction of series of enough rows that strictly rise or fall; a NULL breaks them."""
    long = long_form(df, [c for c in columns if c in df.columns])
    w = Window.partitionBy("geoid", "scenario", "metric").orderBy("year")
    steps = long.withColumns({"n": F.row_number().over(w), "d": F.col("value") - F.lag("value").over(w)})
    up, down = (F.col("n") == 1) | F.coalesce(F.col("d") > 0, F.lit(False)), (F.col("n") == 1) | F.coalesce(F.col("d") < 0, F.lit(False))
    s = steps.groupBy("geoid", "scenario", "metric").agg(F.count("*").alias("rows"), F.bool_and(up).alias("up"), F.bool_and(down).alias("down"))
    return s.where(F.col("rows") >= t.monotonic_rows).where("up or down").select("geoid", "scenario", "metric", F.when(F.col("up"), "rising").otherwise("falling").alias("direction"))


def temperature_logic(df: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """One row: rows where min > mean, mean > max or min > max by more than the tolerance."""
    lo, mid, hi = F.col("min_temp_c"), F.col("mean_temp_c"), F.col("max_temp_c")
    return df.agg(F.count_if(lo > mid + t.tolerance).alias("min_over_mean"), F.count_if(mid > hi + t.tolerance).alias("mean_over_max"), F.count_if(lo > hi + t.tolerance).alias("min_over_max"))


def day_counts(df: DataFrame) -> DataFrame:
    """One row: rows with more than 365 high-precipitation days."""
    return df.agg(F.count_if(F.col("precip_gt_50mm") > 365).alias("impossible_days"))


def implausible(df: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """metric, below, above: values outside the plausible range, in one pass."""
    present = {c: r for c, r in t.ranges.items() if c in df.columns}
    one = df.agg(*[F.struct(F.count_if(F.col(c) < a).alias("below"), F.count_if(F.col(c) > b).alias("above")).alias(c) for c, (a, b) in present.items()])
    return one.unpivot([], list(present), "metric", "r").select("metric", "r.below", "r.above")


def issue(source: DataFrame, validator: str, severity: str, category: str, message: Column, when: Column, **details: Column) -> DataFrame:
    """Rows of `source` that satisfy `when` as issues."""
    return source.where(when).select(F.lit(validator).alias("validator"), F.lit(severity).alias("severity"), F.lit(category).alias("category"), message.alias("message"), _details(details).alias("details"))


def _details(details: dict[str, Column]) -> Column:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def _series_profile(df: DataFrame, t: Thresholds) -> DataFrame:
    """One row a county and scenario with all that the checks count, from one shuffle and one sort of the table."""
    columns, temps = metric_columns(df), [c for c in ("mean_temp_c", "min_temp_c", "max_temp_c") if c in df.columns]
    w = Window.partitionBy("geoid", "scenario").orderBy("year")
    change = {f"__d_{c}": F.col(c).cast("double") - F.lag(F.col(c).cast("double")).over(w) for c in columns}
    steps = df.withColumns({"__row": F.row_number().over(w), "__before": F.lag("year").over(w), **change})
    first = F.col("__row") == 1
    again = ~first & F.col("year").eqNullSafe(F.col("__before"))
    counts = {"__rows": F.count("*"), "__again": F.count_if(again), "__years": F.count_if(F.col("year").between(*t.years) & ~again)}
    counts |= {f"__null_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    # Every metric column is a temperature or precipitation, so its limit is a number.
    counts |= {f"__jump_{c}": F.max((F.abs(F.col(f"__d_{c}")) > _limit(F.lit(c), t, F.lit(None).cast("double"))).cast("int")) for c in columns}
    for c in temps:
        for name, sign in (("up", 1), ("down", -1)):
            counts[f"__{name}_{c}"] = F.bool_and(first | F.coalesce(sign * F.col(f"__d_{c}") > 0, F.lit(False)))
    lo, mid, hi = F.col("min_temp_c"), F.col("mean_temp_c"), F.col("max_temp_c")
    if len(temps) == 3:
        counts |= {"__min_over_mean": F.count_if(lo > mid + t.tolerance), "__mean_over_max": F.count_if(mid > hi + t.tolerance), "__min_over_max": F.count_if(lo > hi + t.tolerance)}
    if "precip_gt_50mm" in columns:
        counts["__days"] = F.count_if(F.col("precip_gt_50mm") > 365)
    for c, (a, b) in t.ranges.items():
        if c in df.columns:
            counts |= {f"__below_{c}": F.count_if(F.col(c) < a), f"__above_{c}": F.count_if(F.col(c) > b)}
    return steps.groupBy("geoid", "scenario").agg(*[x.alias(k) for k, x in counts.items()])


def issues(df: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """All issues of the quality validator: one row a finding, summed over counties.

    The same findings as of the checks above one by one, from one scan: series are profiled, then counties, then the whole.
    """
    columns, temps = metric_columns(df), [c for c in ("mean_temp_c", "min_temp_c", "max_temp_c") if c in df.columns]
    series = _series_profile(df, t)
    span = t.years[1] - t.years[0] + 1
    summed = [c for c in series.columns if c.startswith(("__rows", "__again", "__null_", "__min_", "__mean_", "__days", "__below_", "__above_"))]
    counts = {c: F.sum(c) for c in summed}
    counts["__incomplete"] = F.count_if(F.col("__years") < span)
    counts |= {f"__jumps_{c}": F.count_if(F.col(f"__jump_{c}") > 0) for c in columns}
    counts |= {f"__monotonic_{c}": F.count_if((F.col("__rows") >= t.monotonic_rows) & (F.col(f"__up_{c}") | F.col(f"__down_{c}"))) for c in temps}
    lacks = [F.max(F.coalesce(F.col("scenario") == s, F.lit(False))) for s in t.scenarios]
    by_county = series.groupBy("geoid").agg(*[x.alias(k) for k, x in counts.items()], (~reduce(lambda a, b: a & b, lacks, F.lit(True))).alias("__lacks"))
    total = by_county.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts], F.count_if("__lacks").alias("__lacking"), F.count("geoid").alias("__counties"))

    n = F.col
    percent = {c: F.when(n("__rows") > 0, 100.0 * n(f"__null_{c}") / n("__rows")).otherwise(0.0) for c in df.columns}
    found = [("WARNING", "Data Completeness", f"{c} lacks values", p > t.missing_percent, {"percent": F.round(p, 2)}) for c, p in percent.items()]
    found += [
        ("CRITICAL", "Data Completeness", "duplicate county, year and scenario", n("__again") > 0, {"count": n("__again")}),
        ("WARNING", "Data Completeness", "series lack years", n("__incomplete") > 0, {"count": n("__incomplete")}),
        ("WARNING", "Spatial Consistency", "counties lack scenarios", n("__lacking") > 0, {"count": n("__lacking")}),
        ("WARNING", "Spatial Consistency", "too few counties", n("__counties") < t.county_share * t.expected_counties, {"counties": n("__counties"), "expected": F.lit(t.expected_counties)}),
    ]
    found += [("WARNING", "Temporal Consistency", f"extreme yearly changes of {c}", n(f"__jumps_{c}") > 0, {"series": n(f"__jumps_{c}")}) for c in columns]
    found += [("INFO", "Temporal Consistency", f"monotonic series of {c}", n(f"__monotonic_{c}") > 0, {"series": n(f"__monotonic_{c}")}) for c in temps]
    found += [("CRITICAL", "Logical Relationships", c[2:], n(c) > 0, {"count": n(c)}) for c in ("__min_over_mean", "__mean_over_max", "__min_over_max") if c in summed]
    found += [("CRITICAL", "Logical Relationships", "more days than a year has", n("__days") > 0, {"count": n("__days")})] if "__days" in summed else []
    found += [("CRITICAL", "Physical Plausibility", f"{c} outside its range", n(f"__below_{c}") + n(f"__above_{c}") > 0, {"below": n(f"__below_{c}"), "above": n(f"__above_{c}")}) for c in t.ranges if c in df.columns]
    rows = F.array(*[F.struct(F.lit("qaqc").alias("validator"), F.lit(s).alias("severity"), F.lit(c).alias("category"), F.lit(m).alias("message"), _details(d).alias("details"), when.alias("__when")) for s, c, m, when, d in found])
    return total.select(F.inline(F.filter(rows, lambda x: x["__when"]))).drop("__when")


def counts_by_severity(found: DataFrame) -> DataFrame:
    return found.groupBy("severity").agg(F.count("*").alias("issues"))


def score(found: DataFrame) -> DataFrame:
    """One row: critical, warnings, quality, passed."""
    s = found.agg(F.count_if(F.col("severity") == "CRITICAL").alias("critical"), F.count_if(F.col("severity") == "WARNING").alias("warnings"))
    grade = F.when(F.col("critical") > 0, "POOR").when(F.col("warnings") > 10, "FAIR").when(F.col("warnings") > 0, "GOOD").otherwise("EXCELLENT")
    return s.select("critical", "warnings", grade.alias("quality"), (F.col("critical") == 0).alias("passed"))


# The number for each grade.
GRADES = {"EXCELLENT": 0.95, "GOOD": 0.85, "FAIR": 0.75, "POOR": 0.5}


def overall(grades: DataFrame, column: str = "quality") -> DataFrame:
    """One row: the mean of the grades' numbers, 0.7 for an unknown one, and whether all passed where that is a column."""
    value = F.lit(0.7)
    for g, x in GRADES.items():
        value = F.when(F.col(column) == g, x).otherwise(value)
    extra = [F.bool_and("passed").alias("all_passed")] if "passed" in grades.columns else []
    return grades.agg(F.avg(value).alias("overall_score"), *extra)


# Precipitation


def _rules() -> dict[str, Column]:
    annual, d50, d100 = F.col("annual_precip_mm"), F.col("precip_gt_50mm"), F.col("precip_gt_100mm")
    by_day = expr.precip_a_high_day(annual, d50)
    return {"wet_few_days": (annual > 2000) & (d50 < 10), "dry_many_days": (annual < 500) & (d50 > 20), "odd_day_mean": (by_day > 500) | ((by_day < 50) & (d50 > 0)), "more_100_than_50": d100 > d50}


def precipitation_patterns(df: DataFrame) -> DataFrame:
    """One row: how many rows each precipitation rule flags."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in _rules().items()])


def precipitation_examples(df: DataFrame, n: int = 5) -> DataFrame:
    """rule, geoid: the first n counties that each rule flags."""
    flagged = [df.where(c).select(F.lit(name).alias("rule"), "geoid").distinct() for name, c in _rules().items()]
    w = Window.partitionBy("rule").orderBy("geoid")
    return reduce(DataFrame.union, flagged).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def problem_rows(df: DataFrame) -> DataFrame:
    """Rows that break a rule, the day mean aside."""
    r = _rules()
    return df.where(r["wet_few_days"] | r["dry_many_days"] | r["more_100_than_50"])


def problems_by(df: DataFrame, by: str) -> DataFrame:
    """scenario or decade, problems."""
    return problem_rows(df).withColumn("decade", expr.decade(F.col("year"))).groupBy(by).agg(F.count("*").alias("problems"))


def persistent_problem_counties(df: DataFrame, over: int = 10) -> DataFrame:
    """geoid, problems over a limit; 50 instead of 10 gives the counties of high density."""
    return problem_rows(df).groupBy("geoid").agg(F.count("*").alias("problems")).where(F.col("problems") > over)


def problem_states(df: DataFrame, top: int = 10) -> DataFrame:
    """state, problems: the states with most; ties by code."""
    return problem_rows(df).groupBy(expr.state_of(F.col("geoid")).alias("state")).agg(F.count("*").alias("problems")).orderBy(F.desc("problems"), "state").limit(top)


def problem_profile(df: DataFrame) -> DataFrame:
    """One row over the yearly problem counts: least, greatest, peak year, slope and its significance, largest jump and its year.

    Years are few, so the window over them is small whatever the table's size.
    """
    years = problem_rows(df).groupBy("year").agg(F.count("*").alias("n"))
    steps = years.withColumn("jump", F.abs(F.col("n") - F.lag("n").over(Window.orderBy("year"))))
    s = steps.agg(
        F.min("n").alias("least"),
        F.max("n").alias("greatest"),
        F.min_by("year", F.struct(-F.col("n"), "year")).alias("peak_year"),
        F.count("*").alias("years"),
        F.regr_slope(F.col("n").cast("double"), F.col("year").cast("double")).alias("slope"),
        F.max("jump").alias("largest_jump"),
        F.min_by("year", F.when(F.col("jump").isNotNull(), F.struct(-F.col("jump"), "year"))).alias("jump_year"),
    )
    trend = F.when(F.col("years") > 10, F.col("slope"))
    return s.select("least", "greatest", "peak_year", "years", trend.alias("slope"), F.coalesce(F.abs(trend) > 1, F.lit(False)).alias("significant"), "largest_jump", F.when(F.col("largest_jump") > 100, F.col("jump_year")).alias("sudden_year"))


def precipitation_issues(df: DataFrame) -> DataFrame:
    """Issues of the precipitation validator; without its columns, one warning."""
    needed = ("annual_precip_mm", "precip_gt_50mm", "precip_gt_100mm")
    if any(c not in df.columns for c in needed):
        return issue(df.sparkSession.range(1), "precipitation", "WARNING", "Missing Columns", F.lit("precipitation columns are missing"), F.lit(True))
    severity = {"wet_few_days": "WARNING", "dry_many_days": "WARNING", "odd_day_mean": "INFO", "more_100_than_50": "CRITICAL"}
    counts = precipitation_patterns(df).unpivot([], list(severity), "rule", "n")
    return reduce(DataFrame.unionByName, [issue(counts.where(F.col("rule") == r), "precipitation", s, "Precipitation", F.col("rule"), F.col("n") > 0, count=F.col("n")) for r, s in severity.items()])
