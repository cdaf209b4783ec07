"""Queries of the quality, precipitation and outlier checks over the county x year table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.operators import outliers, quality
from stratus.plans.registry import query
from stratus.plans.testbed import COUNTY_YEAR, FILES, LONG, county_year, files, read

# The test tables hold the years 1995 to 2001 and about a hundred counties.
T = quality.DEFAULT.with_limits(years=(1995, 2001), expected_counties=120, repeated=1, year_share=0.1, monotonic_rows=3, z=2.0, modified_z=2.5)


def _long(spark, sf_dir):
    return quality.long_form(county_year(spark, sf_dir))


def _text(array):
    return F.concat_ws(",", array)


@query("column:s missing:i percent:d", """select unnest(['mean_temp_c', 'annual_precip_mm', 'precip_gt_50mm']) "column", unnest([a, b, c]) missing, unnest([100.0 * a / n, 100.0 * b / n, 100.0 * c / n]) percent
    from (select count(*) n, count_if(mean_temp_c is null) a, count_if(annual_precip_mm is null) b, count_if(precip_gt_50mm is null) c from county_year)""", COUNTY_YEAR)  # fmt: skip
def missing_pct(spark, sf_dir):
    """Q1."""
    return quality.missing_percent(county_year(spark, sf_dir), ["mean_temp_c", "annual_precip_mm", "precip_gt_50mm"])


@query("column:s percent:d", """select unnest(['geoid', 'mean_temp_c', 'annual_precip_mm']) "column", unnest([0.0, 0.0, p]) percent from (select 100.0 * count_if(annual_precip_mm is null) / count(*) p from county_year)""", COUNTY_YEAR)
def missing_sorted(spark, sf_dir):
    """T8."""
    from stratus.operators.summary import missing_share

    return missing_share(county_year(spark, sf_dir), ("geoid", "mean_temp_c", "annual_precip_mm"))


@query("duplicates:i", """select coalesce(sum(n - 1), 0) duplicates from (select count(*) n from (select geoid, "year", scenario from county_year union all select geoid, "year", scenario from county_year where "year" = 1998) group by geoid, "year", scenario)""", COUNTY_YEAR)
def duplicates(spark, sf_dir):
    """Q2: one year's rows come twice."""
    c = county_year(spark, sf_dir)
    return quality.duplicates(c.union(c.where("year = 1998")))


@query("geoid:s scenario:s missing_years:i", """select geoid, scenario, 7 - count(distinct "year") missing_years from county_year where "year" between 1995 and 2001 group by all having count(distinct "year") < 7""", COUNTY_YEAR)
def incomplete_series(spark, sf_dir):
    """Q3, U4."""
    return quality.incomplete_series(county_year(spark, sf_dir), T)


@query("geoid:s scenario:s missing_years:i", """select geoid, scenario, case scenario when 'historical' then 3 else 6 end - count(distinct "year") missing_years from county_year
    where scenario = 'historical' and "year" between 1995 and 1997 or scenario <> 'historical' and "year" between 1998 and 2003 group by geoid, scenario having count(distinct "year") < case scenario when 'historical' then 3 else 6 end""", COUNTY_YEAR)  # fmt: skip
def incomplete_by_scenario(spark, sf_dir):
    """Q3 against each scenario's own range."""
    return quality.incomplete_series(county_year(spark, sf_dir), T, {"historical": (1995, 1997), "ssp245": (1998, 2003), "ssp585": (1998, 2003)})


@query("geoid:s missing:s", """select geoid, string_agg(s, ',' order by s) missing from (select geoid, s from (select distinct geoid from county_year), (select unnest(['historical', 'ssp245', 'ssp585', 'ssp126']) s)
    except select geoid, scenario from county_year) group by all""", COUNTY_YEAR)  # fmt: skip
def missing_scenarios(spark, sf_dir):
    """Q4, J7."""
    t = T.with_limits(scenarios=(*T.scenarios, "ssp126"))
    return quality.missing_scenarios(county_year(spark, sf_dir), t).withColumn("missing", _text("missing"))


@query("counties:i expected:i too_few:b", "select count(distinct geoid) counties, 120 expected, count(distinct geoid) < 114 too_few from county_year", COUNTY_YEAR)
def county_count(spark, sf_dir):
    """Q5."""
    return quality.county_count(county_year(spark, sf_dir), T)


STEPS = LONG + """, steps as (select *, abs(value - lag(value) over (partition by geoid, scenario, metric order by "year")) change from long)"""


@query("geoid:s scenario:s metric:s largest_change:d changes:i", """select geoid, scenario, metric, largest_change, changes from (select geoid, scenario, metric, max(change) largest_change, count_if(change > lim) changes, count(*) n
      from (select s.*, case when metric like '%temp%' then 5.0 when metric like '%precip%' then 500.0 end lim from steps s) group by all) where n >= 2 and changes > 0""", STEPS)  # fmt: skip
def yoy_extremes(spark, sf_dir):
    """Q7, W4."""
    return quality.year_over_year(county_year(spark, sf_dir), T)


@query("metric:s series:i", """select metric, count(*) series from (select geoid, scenario, metric from (select s.*, case when metric like '%temp%' then 5.0 else 500.0 end lim from steps s where metric <> 'precip_gt_100mm')
      group by all having count(*) >= 2 and count_if(change > lim) > 0) group by all""", STEPS)  # fmt: skip
def yoy_first_metrics(spark, sf_dir):
    """The first five metrics only."""
    return quality.year_over_year(county_year(spark, sf_dir), T, 5).groupBy("metric").agg(F.count("*").alias("series"))


@query("geoid:s scenario:s metric:s direction:s", """select geoid, scenario, metric, case when up then 'rising' else 'falling' end direction from
      (select geoid, scenario, metric, count(*) n, bool_and(k = 1 or coalesce(d > 0, false)) up, bool_and(k = 1 or coalesce(d < 0, false)) down from
        (select *, value - lag(value) over w d, row_number() over w k from long where metric in ('mean_temp_c', 'min_temp_c', 'max_temp_c') window w as (partition by geoid, scenario, metric order by "year")) group by all)
      where n >= 3 and (up or down)""", LONG)  # fmt: skip
def monotonic(spark, sf_dir):
    """Q8, W5."""
    return quality.monotonic(county_year(spark, sf_dir), T)


@query("min_over_mean:i mean_over_max:i min_over_max:i", "select count_if(min_temp_c > mean_temp_c - 20 + 0.1) min_over_mean, count_if(mean_temp_c - 20 > max_temp_c + 0.1) mean_over_max, count_if(min_temp_c > max_temp_c + 0.1) min_over_max from county_year", COUNTY_YEAR)
def temp_logic(spark, sf_dir):
    """Q9, over means that are shifted by 20 degrees."""
    return quality.temperature_logic(county_year(spark, sf_dir).withColumn("mean_temp_c", F.col("mean_temp_c") - 20), T)


@query("metric:s below:i above:i", """select unnest(['mean_temp_c', 'min_temp_c', 'max_temp_c', 'annual_precip_mm', 'precip_gt_50mm', 'precip_gt_100mm']) metric,
      unnest([count_if(mean_temp_c < -40), count_if(min_temp_c < -50), count_if(max_temp_c < -30), count_if(annual_precip_mm < 0), count_if(precip_gt_50mm < 0), count_if(precip_gt_100mm < 0)]) below,
      unnest([count_if(mean_temp_c > 50), count_if(min_temp_c > 40), count_if(max_temp_c > 60), count_if(annual_precip_mm > 5000), count_if(precip_gt_50mm > 365), count_if(precip_gt_100mm > 365)]) above from county_year""", COUNTY_YEAR)  # fmt: skip
def plausibility(spark, sf_dir):
    """Q10, Q11."""
    return quality.implausible(county_year(spark, sf_dir), T)


NAMES = ("geoid", "year", "scenario", "mean_temp_c", "min_temp_c", "max_temp_c", "annual_precip_mm", "precip_gt_50mm", "precip_gt_100mm", "pixel_count")
RANGES = quality.PLAUSIBLE
ISSUES = STEPS + f""", series as (select geoid, scenario, count(distinct "year") filter ("year" between 1995 and 2001) ny from county_year group by all),
  jumps as (select geoid, scenario, metric from steps group by all having count(*) >= 2 and count_if(change > case when metric like '%temp%' then 5.0 else 500.0 end) > 0),
  mono as (select geoid, scenario, metric from (select *, value - lag(value) over w d, row_number() over w k from long where metric in ('mean_temp_c', 'min_temp_c', 'max_temp_c') window w as (partition by geoid, scenario, metric order by "year"))
    group by all having count(*) >= 3 and (bool_and(k = 1 or coalesce(d > 0, false)) or bool_and(k = 1 or coalesce(d < 0, false)))),
  lacking as (select count(*) n from (select geoid from county_year where scenario in ('historical', 'ssp245', 'ssp585') group by geoid having count(distinct scenario) < 3)),
  whole as (select count(*) total, count(distinct geoid) counties, count(*) - (select count(*) from (select distinct geoid, "year", scenario from county_year)) again, {", ".join(f'count_if("{c}" is null) null_{c}' for c in NAMES)},
    count_if(min_temp_c > mean_temp_c + 0.1) min_over_mean, count_if(mean_temp_c > max_temp_c + 0.1) mean_over_max, count_if(min_temp_c > max_temp_c + 0.1) min_over_max, count_if(precip_gt_50mm > 365) too_many,
    {", ".join(f"count_if({c} < {a}) below_{c}, count_if({c} > {b}) above_{c}" for c, (a, b) in RANGES.items())} from county_year),
  found as (
    {" union all ".join(f"select 'WARNING' severity, '{c} lacks values' message, null n, 100.0 * null_{c} / total > 10 hit from whole" for c in NAMES)}
    union all select 'CRITICAL', 'duplicate county, year and scenario', again, again > 0 from whole
    union all select 'WARNING', 'series lack years', count(*), count(*) > 0 from series where ny < 7
    union all select 'WARNING', 'counties lack scenarios', n, n > 0 from lacking
    union all select 'WARNING', 'too few counties', counties, counties < 0.95 * 120 from whole
    union all select 'WARNING', 'extreme yearly changes of ' || metric, count(*), true from jumps group by metric
    union all select 'INFO', 'monotonic series of ' || metric, count(*), true from mono group by metric
    union all {" union all ".join(f"select 'CRITICAL', '{c}', {c}, {c} > 0 from whole" for c in ("min_over_mean", "mean_over_max", "min_over_max"))}
    union all select 'CRITICAL', 'more days than a year has', too_many, too_many > 0 from whole
    union all {" union all ".join(f"select 'CRITICAL', '{c} outside its range', below_{c} + above_{c}, below_{c} + above_{c} > 0 from whole" for c in RANGES)})"""


@query("severity:s issues:i", "select severity, count(*) issues from found where hit group by all", ISSUES)
def issue_counts(spark, sf_dir):
    """Q13: all issues of the quality validator by severity."""
    return quality.counts_by_severity(quality.issues(county_year(spark, sf_dir), T))


@query("severity:s message:s n:i", "select severity, message, n from found where hit", ISSUES)
def issue_list(spark, sf_dir):
    """Q1 to Q11 in one scan: each finding with its number."""
    d = F.col("details")
    number = F.coalesce(d["count"], d["series"], d["counties"], (d["below"].cast("bigint") + d["above"].cast("bigint")).cast("string"))
    return quality.issues(county_year(spark, sf_dir), T).withColumn("n", number)


@query("impossible_days:i", "select count_if(precip_gt_50mm * 40 > 365) impossible_days from county_year", COUNTY_YEAR)
def impossible_days(spark, sf_dir):
    """Q10, over day counts that are made forty times as large."""
    return quality.day_counts(county_year(spark, sf_dir).withColumn("precip_gt_50mm", F.col("precip_gt_50mm") * 40))


@query("variable:s critical:i warnings:i quality:s passed:b", """select "variable", c critical, w warnings, case when c > 0 then 'POOR' when w > 10 then 'FAIR' when w > 0 then 'GOOD' else 'EXCELLENT' end quality, c = 0 passed from
    (select "variable", count_if("variable" = 'pr' and status = 'failed') c, count_if("variable" in ('pr', 'tas') and quality < 0.5 or "variable" = 'tasmax' and id % 1000 = 2) w from files group by "variable")""", FILES)  # fmt: skip
def quality_score(spark, sf_dir):
    """Q12 for the issues of the files of each variable."""
    from functools import reduce

    v, f = F.col("variable"), files(spark, sf_dir)
    warned = (v.isin("pr", "tas") & (F.col("quality") < 0.5)) | ((v == "tasmax") & (F.col("id") % 1000 == 2))
    found = f.select("variable", F.explode(F.array_compact(F.array(F.when((v == "pr") & (F.col("status") == "failed"), "CRITICAL"), F.when(warned, "WARNING")))).alias("severity"))
    made = [quality.score(found.where(v == name)).withColumn("variable", F.lit(name)) for name in ("pr", "tas", "tasmax", "tasmin")]
    return reduce(lambda a, b: a.unionByName(b), made)


@query("critical:i warnings:i quality:s passed:b", """select c critical, w warnings, case when c > 0 then 'POOR' when w > 10 then 'FAIR' when w > 0 then 'GOOD' else 'EXCELLENT' end quality, c = 0 passed
    from (select count_if(severity = 'CRITICAL') c, count_if(severity = 'WARNING') w from found where hit)""", ISSUES)  # fmt: skip
def quality_score_of_table(spark, sf_dir):
    """Q12 for the issues that the county table has."""
    return quality.score(quality.issues(county_year(spark, sf_dir), T))


@query("overall_score:d all_passed:b", """select avg(case when quality >= 0.9 then 0.95 when quality >= 0.6 then 0.85 when quality >= 0.3 then 0.75 when quality >= 0.1 then 0.5 else 0.7 end) overall_score, bool_and(status = 'completed') all_passed from files""", FILES)
def overall_score_of_files(spark, sf_dir):
    """A40 over the grades of all files, the lowest of which have none that is known."""
    q = F.col("quality")
    grade = F.when(q >= 0.9, "EXCELLENT").when(q >= 0.6, "GOOD").when(q >= 0.3, "FAIR").when(q >= 0.1, "POOR").otherwise("ODD")
    return quality.overall(files(spark, sf_dir).select(grade.alias("quality"), (F.col("status") == "completed").alias("passed")))


@query("overall_score:d all_passed:b", """select avg(case when s_acctbal >= 8000 then 0.95 when s_acctbal >= 6000 then 0.85 when s_acctbal >= 4000 then 0.75 when s_acctbal >= 2000 then 0.5 else 0.7 end) overall_score, bool_and(s_acctbal >= -999.99) all_passed from supplier""")
def overall_score(spark, sf_dir):
    """A40 over a grade of each cell."""
    b = F.col("s_acctbal")
    grade = F.when(b >= 8000, "EXCELLENT").when(b >= 6000, "GOOD").when(b >= 4000, "FAIR").when(b >= 2000, "POOR").otherwise("ODD")
    return quality.overall(read(spark, sf_dir, "supplier").select(grade.alias("quality"), (b >= -999.99).alias("passed")))


RULES = """, r as (select *, annual_precip_mm > 2000 and precip_gt_50mm < 10 r1, annual_precip_mm < 500 and precip_gt_50mm > 20 r2,
    (case when precip_gt_50mm > 0 then annual_precip_mm / precip_gt_50mm else 0 end) d, precip_gt_100mm > precip_gt_50mm r4 from county_year),
  p as (select * from r where r1 or r2 or r4)"""


def _shifted(spark, sf_dir):
    """Precipitation such that each rule has rows: some counties get more hundreds than fifties, some little rain."""
    c = county_year(spark, sf_dir)
    n = F.col("geoid").cast("int")
    return c.withColumns({"precip_gt_100mm": F.when(n % 5 == 0, F.col("precip_gt_50mm") + 1).otherwise(F.col("precip_gt_100mm")), "precip_gt_50mm": F.when(n % 3 == 0, F.col("precip_gt_50mm") / 8).otherwise(F.col("precip_gt_50mm") + 10), "annual_precip_mm": F.when(n % 4 == 0, F.col("annual_precip_mm") / 10).otherwise(F.col("annual_precip_mm") * 2)})


SHIFTED = COUNTY_YEAR.replace("county_year as (", "county_year0 as (") + """, county_year as (select geoid, "year", scenario,
  case when cast(geoid as int) % 5 = 0 then precip_gt_50mm + 1 else precip_gt_100mm end precip_gt_100mm, case when cast(geoid as int) % 3 = 0 then precip_gt_50mm / 8 else precip_gt_50mm + 10 end precip_gt_50mm,
  case when cast(geoid as int) % 4 = 0 then annual_precip_mm / 10 else annual_precip_mm * 2 end annual_precip_mm from county_year0)""" + RULES


@query("wet_few_days:i dry_many_days:i odd_day_mean:i more_100_than_50:i", "select count_if(r1) wet_few_days, count_if(r2) dry_many_days, count_if(d > 500 or d < 50 and precip_gt_50mm > 0) odd_day_mean, count_if(r4) more_100_than_50 from r", SHIFTED)
def precip_patterns(spark, sf_dir):
    """P1 to P4, C23."""
    return quality.precipitation_patterns(_shifted(spark, sf_dir))


@query("rule:s geoid:s", """select rule, geoid from (select rule, geoid, row_number() over (partition by rule order by geoid) n from
    (select distinct 'wet_few_days' rule, geoid from r where r1 union all select distinct 'dry_many_days', geoid from r where r2 union all select distinct 'odd_day_mean', geoid from r where d > 500 or d < 50 and precip_gt_50mm > 0 union all select distinct 'more_100_than_50', geoid from r where r4)) where n <= 5""", SHIFTED)  # fmt: skip
def precip_examples(spark, sf_dir):
    """Example counties of each rule."""
    return quality.precipitation_examples(_shifted(spark, sf_dir))


@query("scenario:s problems:i", "select scenario, count(*) problems from p group by all", SHIFTED)
def precip_by_group(spark, sf_dir):
    """P5 by scenario."""
    return quality.problems_by(_shifted(spark, sf_dir), "scenario")


@query("decade:i problems:i", 'select "year" // 10 * 10 as decade, count(*) problems from p group by all', SHIFTED)
def precip_by_decade(spark, sf_dir):
    """P5 by decade."""
    return quality.problems_by(_shifted(spark, sf_dir), "decade")


@query("geoid:s problems:i", "select geoid, count(*) problems from p group by all having count(*) > 4", SHIFTED)
def persistent_problem_counties(spark, sf_dir):
    """P6."""
    return quality.persistent_problem_counties(_shifted(spark, sf_dir), 4)


@query("state:s problems:i", "select geoid[1:2] state, count(*) problems from p group by all order by problems desc, state limit 10", SHIFTED)
def problem_states_top10(spark, sf_dir):
    """P7, T4."""
    return quality.problem_states(_shifted(spark, sf_dir))


@query("least:i greatest:i peak_year:i years:i slope:d significant:b largest_jump:i sudden_year:i", """select min(n) least, max(n) greatest, arg_min("year", (-n, "year")) peak_year, count(*) as years, cast(null as double) slope, false significant, max(j) largest_jump,
    case when max(j) > 100 then arg_min("year", (-j, "year")) filter (j is not null) end sudden_year from (select *, abs(n - lag(n) over (order by "year")) j from (select "year", count(*) n from p group by all))""", SHIFTED)  # fmt: skip
def issue_year_profile(spark, sf_dir):
    """P8 to P10, T6, W6."""
    return quality.problem_profile(_shifted(spark, sf_dir))


IQR = LONG + """, fences as (select metric, scenario, "year", quantile_cont(value, 0.25) a, quantile_cont(value, 0.75) b from long group by all),
  iqr_rows as (select l.* from long l join fences f using (metric, scenario, "year") where value < a - 1.5 * (b - a) or value > b + 1.5 * (b - a)),
  iqr as (select metric, scenario, geoid, hits from (select metric, scenario, geoid, count(*) hits from iqr_rows group by all) join (select scenario, count(distinct "year") ny from long group by all) using (scenario) where hits > 0.1 * ny)"""
Z = """, z as (select metric, scenario, geoid, count(*) hits from long join (select metric, scenario, avg(value) m, stddev_samp(value) s from long group by all) using (metric, scenario) where s > 0 and abs(value - m) > 2.0 * s group by all having count(*) > 1)"""
M = """, off as (select *, abs(value - m) o from long join (select metric, scenario, median(value) m from long group by all) using (metric, scenario)),
  mz as (select metric, scenario, geoid, count(*) hits from off join (select metric, scenario, median(o) mad from off group by all) using (metric, scenario) where mad > 0 and 0.6745 * o > 2.5 * mad group by all having count(*) > 1)"""
ALL = IQR + Z + M + """, found as (select 'iqr' method, * from iqr union all select 'zscore', * from z union all select 'modified_zscore', * from mz)"""
HITS = "metric:s scenario:s geoid:s hits:i"


@query(HITS, "select * from iqr", IQR)
def outliers_iqr(spark, sf_dir):
    """O1, Q6."""
    return outliers.iqr(_long(spark, sf_dir), T)


@query(HITS, "select * from z", LONG + Z)
def outliers_zscore(spark, sf_dir):
    """O2, W8."""
    return outliers.zscore(_long(spark, sf_dir), T)


@query(HITS, "select * from mz", LONG + M)
def outliers_modz(spark, sf_dir):
    """O3."""
    return outliers.modified_zscore(_long(spark, sf_dir), T)


@query("geoid:s detections:i", "select geoid, count(*) detections from found group by all having count(*) >= 3", ALL)
def outliers_persistent(spark, sf_dir):
    """O4."""
    return outliers.persistent(outliers.all_methods(_long(spark, sf_dir), T))


@query("state:s counties:i", "select geoid[1:2] state, count(*) counties from (select geoid from found group by all having count(*) >= 3) group by all", ALL)
def outliers_by_state(spark, sf_dir):
    """O5."""
    return outliers.by_state(outliers.persistent(outliers.all_methods(_long(spark, sf_dir), T)))


@query("state:s counties:i", "select geoid[1:2] state, count(*) counties from (select geoid from found group by all having count(*) >= 3) where geoid in (select county from obs where lat > 0) group by all", ALL)
def outliers_of_listed_counties(spark, sf_dir):
    """O5 with J8: only counties of a list."""
    from stratus.plans.testbed import obs

    listed = obs(spark, sf_dir).where("lat > 0").select(F.col("county").alias("geoid")).distinct()
    return outliers.by_state(outliers.persistent(outliers.all_methods(_long(spark, sf_dir), T)), listed)


@query("method:s metrics:i detections:i", "select method, count(distinct metric) metrics, count(*) detections from found group by all", ALL)
def outlier_findings(spark, sf_dir):
    """O6."""
    return outliers.findings(outliers.all_methods(_long(spark, sf_dir), T))


@query("metric:s geoid:s hits:i rank:i", """select * from (select *, row_number() over (partition by metric order by hits desc, geoid) rank from (select metric, geoid, count(*) hits from iqr_rows group by all)) where rank <= 5""", IQR)
def outlier_top5(spark, sf_dir):
    """T3."""
    return outliers.top_counties(_long(spark, sf_dir), T)
