"""Queries of the climatology, coordinate and window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.functions import expr
from stratus.operators import climatology
from stratus.plans.registry import query
from stratus.plans.testbed import FILES, OBS, files, obs, read
from stratus.regions import REGIONS
from stratus.sources import catalog

WINDOW, MIN_YEARS = 3, 2
DAILY = f"""{OBS}, leap as (
  select *, ("year" % 4 = 0 and ("year" % 100 <> 0 or "year" % 400 = 0)) is_leap from obs), std as (
  select * replace (case when is_leap and doy > 60 then doy - 1 else least(doy, 365) end as doy) from leap where not (is_leap and doy = 60)), daily as (
  select scenario, "year", doy, lat, lon, avg(tas) value from std group by all)"""


def _daily(spark, sf_dir):
    return climatology.daily_climatology(obs(spark, sf_dir), "tas", ("scenario", "year"))


@query("scenario:s year:i doy:i lat:d lon:d value:d", "select * from daily", DAILY)
def daily_climatology(spark, sf_dir):
    """A1 with C14: mean by cell and day of each year over 365 days."""
    return _daily(spark, sf_dir)


@query("year:i doy:i lat:d lon:d value:d", 'select "year", doy, lat, lon, avg(tas) value from obs group by all', OBS)
def daily_climatology_calendar(spark, sf_dir):
    """A1 with C13: days as the calendar numbers them."""
    return climatology.daily_climatology(obs(spark, sf_dir), "tas", ("year",), "calendar")


NORMAL = """select target_year, doy, lat, lon, avg(value) value, max(num_years) num_years, max(source_start) source_start, max(source_end) source_end
  from (select *, unnest(range("year", "year" + 3)) target_year from {daily}) join
    (select target_year, count(*) num_years, min("year") source_start, max("year") source_end from
      (select "year", unnest(range("year", "year" + 3)) target_year from (select distinct "year" from {daily})) group by all having count(*) >= 2) using (target_year)
  group by all"""


@query("target_year:i doy:i lat:d lon:d value:d num_years:i source_start:i source_end:i", NORMAL.format(daily="(select \"year\", doy, lat, lon, avg(value) value from daily group by all)"), DAILY)
def climate_normal(spark, sf_dir):
    """A2 with W1 and F9: trailing windows of three years with at least two."""
    years = climatology.mean_over(_daily(spark, sf_dir), "year")
    return climatology.climate_normal(years, WINDOW, MIN_YEARS, (), readings=expr.leap_365(obs(spark, sf_dir)))


@query("target_year:i doy:i lat:d lon:d value:d num_years:i source_start:i source_end:i", NORMAL.format(daily="(select * from daily where scenario = 'historical' and \"year\" <= 1997 or scenario = 'ssp245' and \"year\" > 1997)"), DAILY)
def hybrid_normal(spark, sf_dir):
    """S9 with W1: historical years up to the cut, projected ones after it."""
    rows = climatology.hybrid_rows(obs(spark, sf_dir), 1997)
    return climatology.climate_normal(climatology.daily_climatology(rows, "tas", ("scenario", "year")), WINDOW, MIN_YEARS, (), readings=expr.leap_365(rows))


@query(
    "target_year:i scenario:s files:i",
    """select target_year, scenario, count(*) files from
      (select "year", case when bool_or(scenario = 'historical') then 'historical' else 'ssp245' end scenario from files where scenario in ('historical', 'ssp245') group by all) b
      join (select t target_year, unnest(range(t - 2, t + 1)) "year" from range(1995, 2003) r(t)) w using ("year") group by all""",
    FILES,
)
def hybrid_window_sources(spark, sf_dir):
    """For each window, years read from each scenario."""
    return climatology.hybrid_sources(files(spark, sf_dir), spark.range(1995, 2003).select(F.col("id").cast("int").alias("target_year")), WINDOW)


@query(
    "scenario:s target_year:i doy:i lat:d lon:d value:d num_years:i",
    """select plan_scenario scenario, target_year, doy, lat, lon, avg(value) value, max(num_years) num_years from
      (select d.*, p.plan_scenario, p.target_year from daily d join pairs p on d."year" = p."year" and d.scenario = p.scenario) join
      (select plan_scenario, target_year, count(distinct "year") num_years from pairs semi join daily using ("year", scenario) group by all having count(distinct "year") >= 2) using (plan_scenario, target_year)
      group by all""",
    DAILY + """, pairs as (select s.plan_scenario, y.target_year, y."year", case when y."year" <= 1997 then 'historical' else s.plan_scenario end scenario
      from (select unnest(['ssp245', 'ssp585']) plan_scenario) s, (select t target_year, unnest(range(t - 2, t + 1)) "year" from range(1998, 2001) r(t)) y)""",
)
def planned_normals(spark, sf_dir):
    """All windows of a plan in one pass."""
    plan = spark.createDataFrame([(s, "hybrid", t, t - 2, t) for s in ("ssp245", "ssp585") for t in range(1998, 2001)], "scenario string, period_type string, target_year int, start_year int, end_year int")
    readings = expr.leap_365(obs(spark, sf_dir)).withColumn("variable", F.lit("tas"))
    return climatology.normals_from_plan(_daily(spark, sf_dir).withColumn("variable", F.lit("tas")), plan, MIN_YEARS, 1997, readings)


@query(
    "target_year:i doy:i lat:d value:d num_years:i source_start:i source_end:i",
    """select target_year, doy, lat, avg(v) "value", max(n) num_years, max(a) source_start, max(b) source_end from (select "year", doy, lat, avg(v) v from days group by all)
      join (select y.t target_year, count(*) n, min("year") a, max("year") b from (select distinct "year" from days), (select unnest(range(1950, 2051)) t) y where "year" between y.t - 29 and y.t group by all having count(*) >= 25) w
        on "year" between w.target_year - 29 and w.target_year group by all""",
    """days as (select * from (select 1950 + l_orderkey * 31 % 73 "year", l_linenumber doy, l_suppkey % 25 * 1.0 lat, l_quantity v from lineitem) where "year" not in (1960, 1971, 1972, 1973, 1974, 1980))""",
)
def normal_of_30_years(spark, sf_dir):
    """A2, W1, F9 as in production: windows of 30 years with at least 25 that hold data."""
    days = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select((1950 + F.col("l_orderkey") * 31 % 73).cast("int").alias("year"), F.col("l_linenumber").alias("doy"), (F.col("l_suppkey") % 25).cast("double").alias("lat"), F.lit(0.0).alias("lon"), F.col("l_quantity").alias("value"))
    days = days.where(~F.col("year").isin(1960, 1971, 1972, 1973, 1974, 1980))
    return climatology.climate_normal(climatology.daily_climatology(days, "value", ("year",), "calendar"), keys=(), readings=days)


@query("scenario:s period_type:s windows:i first_target:i last_target:i first_year:i files:i", """select scenario, period_type, count(*) windows, min(t) first_target, max(t) last_target, min(a) first_year, sum(n) as files from
    (select p.scenario, period_type, t, a, count(f."year") as n from (select *, case when period_type = 'historical' then greatest(1950, t - 29) else t - 29 end as a from
      (select 'historical' scenario, 'historical' period_type, unnest(range(1980, 2015)) t
       union all select s, 'hybrid', unnest(range(2015, 2045)) from (select unnest(['ssp126', 'ssp245', 'ssp370', 'ssp585']) s)
       union all select s, s, unnest(range(2045, 2101)) from (select unnest(['ssp126', 'ssp245', 'ssp370', 'ssp585']) s))) p
     left join files f on f."year" between a and t group by all) group by all""", FILES)  # fmt: skip
def period_plan(spark, sf_dir):
    """The windows of a model by scenario, and how many files they take in."""
    yearly = files(spark, sf_dir).groupBy("year").agg(F.count("*").alias("files"))
    plan = climatology.period_plan(spark).select("scenario", "period_type", "target_year", "start_year", F.explode(F.sequence("start_year", "target_year")).alias("year"))
    windows = plan.join(yearly, "year", "left").groupBy("scenario", "period_type", "target_year", "start_year").agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files"))
    return windows.groupBy("scenario", "period_type").agg(F.count("*").alias("windows"), F.min("target_year").alias("first_target"), F.max("target_year").alias("last_target"), F.min("start_year").alias("first_year"), F.sum("files").alias("files"))


@query("lat:d lon:d value:d", "select lat, lon, avg(tas) value from obs group by all", OBS)
def period_climatology(spark, sf_dir):
    """A3: one mean over time by cell."""
    return climatology.climatology_of_period(obs(spark, sf_dir), "tas", ())


@query("cell_id:i lat:d lon:d readings:i", "select cell_id, lat, lon, count(*) readings from obs where lat between 24 and 50 and lon between 234 and 294 group by all", OBS)
def region_box(spark, sf_dir):
    """a region's box."""
    return climatology.region_box(obs(spark, sf_dir), REGIONS["CONUS"]).groupBy("cell_id", "lat", "lon").agg(F.count("*").alias("readings"))


@query("cell_id:i lon:d readings:i", "select cell_id, case when lon > 180 then lon - 360 else lon end lon, count(*) readings from obs where lat between 50 and 72 and (lon >= 170 and lon <= 180 or lon > 180 and lon <= 235) group by all", OBS)
def dateline_box(spark, sf_dir):
    """F1 with C3: a box across the date line in -180..180."""
    shifted = obs(spark, sf_dir).withColumn("lon", expr.lon_180(F.col("lon")))
    return climatology.region_box(shifted, REGIONS["AK"], is_360=False).groupBy("cell_id", "lon").agg(F.count("*").alias("readings"))


@query("cell_id:i lon:d west:d back:d", "select distinct cell_id, lon, case when lon > 180 then lon - 360 else lon end west, case when (case when lon > 180 then lon - 360 else lon end) < 0 then (case when lon > 180 then lon - 360 else lon end) + 360 else lon end back from obs", OBS)
def lon_wrap(spark, sf_dir):
    """Both longitude conventions."""
    west = expr.lon_180(F.col("lon"))
    return obs(spark, sf_dir).select("cell_id", "lon").distinct().select("cell_id", "lon", west.alias("west"), expr.lon_360(west).alias("back"))


@query("is_360:b is_indexed:b", "select min(lon) >= 0 and max(lon) > 180 is_360, min(lon) = 0 and min(lat) = 0 and max(lon) < 500 and max(lat) < 200 is_indexed from obs", OBS)
def coordinate_convention(spark, sf_dir):
    """C4: which convention the coordinates follow."""
    return expr.convention(obs(spark, sf_dir))


@query("year:i doy:i readings:i", 'select "year", doy, count(*) readings from std group by all', DAILY)
def leap_365(spark, sf_dir):
    """C14: days of every year numbered to 365."""
    return expr.leap_365(obs(spark, sf_dir)).groupBy("year", "doy").agg(F.count("*").alias("readings"))


@query("synthetic_doy:i readings:i", 'select (n - 1) % 365 + 1 synthetic_doy, count(*) readings from (select row_number() over (partition by l_suppkey order by l_shipdate, l_orderkey, l_linenumber) n from lineitem) group by all')
def synthetic_doy(spark, sf_dir):
    """Days numbered by place in the file."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("at"))
    return expr.doy_synthetic(rows, ["l_suppkey"], "at", "synthetic_doy").groupBy("synthetic_doy").agg(F.count("*").alias("readings"))


@query("year:i days:i readings:i", 'select "year", case when is_leap then 366 else 365 end as days, count(*) readings from leap group by all', DAILY)
def days_in_year(spark, sf_dir):
    """Days of each year."""
    return obs(spark, sf_dir).groupBy("year").agg(F.count("*").alias("readings")).withColumn("days", expr.days_in_year(F.col("year")))


@query("variable:s scenario:s year:i version:s files:i", """select variable, scenario, "year", case when has_version then '1.1' end "version", count(*) files from files group by all""", FILES)
def file_metadata(spark, sf_dir):
    """What file names tell."""
    named = catalog.with_metadata(files(spark, sf_dir).select("path"))
    return named.groupBy("variable", "scenario", "year", "version").agg(F.count("*").alias("files"))


@query("season:s lat:d lon:d mean:d", """select case when doy between 335 and 366 or doy between 1 and 59 then 'DJF' when doy between 60 and 151 then 'MAM' when doy between 152 and 243 then 'JJA' else 'SON' end season, lat, lon, avg(tas) mean from obs group by all""", OBS)
def seasonal_means(spark, sf_dir):
    """Means by season and cell."""
    from stratus.operators.summary import seasonal_means as means

    return means(obs(spark, sf_dir), "tas", "lat", "lon")


@query("season:s mean:d", """select season, avg(tas) mean from (select unnest(['Winter', 'Spring', 'Summer', 'Fall']) season, unnest([1, 60, 150, 244]) a, unnest([59, 151, 240, 334]) b) s join obs on doy between a and b group by all""", OBS)
def display_seasons(spark, sf_dir):
    """Means by the overlapping display seasons."""
    from stratus.operators.summary import display_season_means

    return display_season_means(obs(spark, sf_dir), "tas")


@query("id:i detected:s", """select s_suppkey as id, case when abs(a - 234) < 5 and abs(b - 294) < 5 and abs(c - 24) < 2 and abs(d - 50) < 2 then 'CONUS' when abs(a - 170) < 5 and abs(b - 235) < 5 and abs(c - 50) < 2 and abs(d - 72) < 2 then 'AK'
    when abs(a - 181.63) < 5 and abs(b - 205.2) < 5 and abs(c - 18.92) < 2 and abs(d - 28.45) < 2 then 'HI' else 'CONUS' end detected from (select s_suppkey, 168 + s_suppkey % 8 a, 233 + s_suppkey % 8 b, 49 + s_suppkey % 3 c, 71 + s_suppkey % 3 d from supplier)""")  # fmt: skip
def region_detection(spark, sf_dir):
    """The region of a box."""
    i = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(i.alias("id"), expr.region_of_box(168 + i % 8, 233 + i % 8, 49 + i % 3, 71 + i % 3).alias("detected"))


@query("id:i year:i scenario:s decade:i", """select o_orderkey as id, y "year", case when y between 1850 and 2014 then 'historical' when y between 2015 and 2100 then 'ssp245' end scenario, y // 10 * 10 as decade from (select o_orderkey, 1840 + o_orderkey % 270 as y from orders)""")
def scenario_of_year(spark, sf_dir):
    """Scenario and decade of a year."""
    y = (1840 + F.col("o_orderkey") % 270).cast("int")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), y.alias("year"), expr.scenario_of_year(y).alias("scenario"), expr.decade(y).alias("decade"))
