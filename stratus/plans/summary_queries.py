"""Queries of the summaries, the catalogue, the manifest and the spatial operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.operators import contracts, spatial, summary
from stratus.plans.manifest import latest, pending
from stratus.plans.registry import query
from stratus.plans.testbed import CELLS, COUNTIES, COUNTY_YEAR, FILES, OBS, cells, counties, county_year, files, obs
from stratus.sources import catalog

METRICS = ("mean_temp_c", "annual_precip_mm", "precip_gt_50mm")


@query("records:i counties:i coverage:d", "select count(*) records, count(distinct geoid) counties, 100.0 * count(annual_precip_mm) / count(*) coverage from county_year", COUNTY_YEAR)
def region_summary(spark, sf_dir):
    """A18."""
    return summary.region_summary(county_year(spark, sf_dir), "annual_precip_mm")


@query("scenario:s rows:i", 'select scenario, count(*) "rows" from county_year group by all', COUNTY_YEAR)
def rows_by_scenario(spark, sf_dir):
    """A19, A23."""
    return summary.rows_by(county_year(spark, sf_dir), "scenario")


@query("year:i rows:i", 'select "year", count(*) "rows" from county_year group by all', COUNTY_YEAR)
def rows_by_year(spark, sf_dir):
    """A23."""
    return summary.rows_by(county_year(spark, sf_dir), "year")


@query("geoid:s mean:d", """select geoid, avg(mean_temp_c) mean from county_year where "year" between 1996 and 1999 group by all""", COUNTY_YEAR)
def period_means(spark, sf_dir):
    """A20."""
    return summary.period_mean(county_year(spark, sf_dir), "mean_temp_c", 1996, 1999)


@query("geoid:s historical:d future:d change:d", """select geoid, h historical, f future, f - h change from (select geoid, avg(mean_temp_c) h from county_year where scenario = 'historical' and "year" between 1995 and 1996 group by all)
    full join (select geoid, avg(mean_temp_c) f from county_year where scenario = 'ssp245' and "year" between 1999 and 2001 group by all) using (geoid)""", COUNTY_YEAR)  # fmt: skip
def scenario_change(spark, sf_dir):
    """A21, J9."""
    return summary.scenario_change(county_year(spark, sf_dir), "mean_temp_c", "ssp245", (1999, 2001), (1995, 1996))


@query("geoid:s completeness:d years:i", """select geoid, 100 * avg((cast(mean_temp_c is not null as int) + cast(annual_precip_mm is not null as int)) / 2) completeness, count(distinct "year") as years from county_year group by all""", COUNTY_YEAR)
def county_completeness(spark, sf_dir):
    """A22."""
    return summary.completeness(county_year(spark, sf_dir), ("mean_temp_c", "annual_precip_mm"))


@query("year:i historical:d ssp245:d ssp585:d", """select "year", avg(mean_temp_c) filter (scenario = 'historical') historical, avg(mean_temp_c) filter (scenario = 'ssp245') ssp245, avg(mean_temp_c) filter (scenario = 'ssp585') ssp585 from county_year group by all""", COUNTY_YEAR)
def year_scenario_pivot(spark, sf_dir):
    """A24."""
    return summary.year_by_scenario(county_year(spark, sf_dir), "mean_temp_c", ("historical", "ssp245", "ssp585"))


@query("a:s b:s corr:d", """select unnest(['mean_temp_c', 'mean_temp_c', 'annual_precip_mm']) a, unnest(['annual_precip_mm', 'precip_gt_50mm', 'precip_gt_50mm']) b,
    unnest([corr(mean_temp_c, annual_precip_mm), corr(mean_temp_c, precip_gt_50mm), corr(annual_precip_mm, precip_gt_50mm)]) corr from county_year""", COUNTY_YEAR)  # fmt: skip
def metric_corr(spark, sf_dir):
    """A25."""
    return summary.correlations(county_year(spark, sf_dir), METRICS)


@query("scenario:s slope:d intercept:d", 'select scenario, regr_slope(mean_temp_c, "year") slope, regr_intercept(mean_temp_c, "year") intercept from county_year group by all', COUNTY_YEAR)
def trend(spark, sf_dir):
    """A26."""
    return summary.trend(county_year(spark, sf_dir), "mean_temp_c", "year", ("scenario",))


@query("bin:i low:d n:i", """select b bin, lo + b * (hi - lo) / 30 low, count(*) n from (select *, least(floor((mean_temp_c - lo) / ((hi - lo) / 30)), 29) b from county_year, (select min(mean_temp_c) lo, max(mean_temp_c) hi from county_year)) group by all""", COUNTY_YEAR)
def histogram(spark, sf_dir):
    """A27."""
    return summary.histogram(county_year(spark, sf_dir), "mean_temp_c", 30)


@query("decade:i q1:d median:d q3:d min:d max:d n:i", 'select "year" // 10 * 10 as decade, quantile_cont(mean_temp_c, 0.25) q1, quantile_cont(mean_temp_c, 0.5) median, quantile_cont(mean_temp_c, 0.75) q3, min(mean_temp_c) min, max(mean_temp_c) max, count(mean_temp_c) n from county_year group by all', COUNTY_YEAR)
def decade_quartiles(spark, sf_dir):
    """A28."""
    from stratus.functions.expr import decade

    return summary.quartiles(county_year(spark, sf_dir), "mean_temp_c", decade(F.col("year")), "decade")


@query("doy:i mean:d", "select doy, avg(tas) mean from obs group by all", OBS)
def spatial_mean_series(spark, sf_dir):
    """A29."""
    return summary.spatial_mean(obs(spark, sf_dir), "tas", "doy")


@query("year:i mean:d", 'select "year", avg(tas) mean from obs group by all', OBS)
def annual_spatial_mean(spark, sf_dir):
    """A30."""
    return summary.spatial_mean(obs(spark, sf_dir), "tas", "year")


@query("state:s mean:d n:i", "select geoid[1:2] state, avg(mean_temp_c) mean, count(mean_temp_c) n from county_year group by all having count(mean_temp_c) >= 5 order by state limit 10", COUNTY_YEAR)
def state_means(spark, sf_dir):
    """A32."""
    return summary.state_means(county_year(spark, sf_dir), "mean_temp_c")


DESCRIBE = "n:i mean:d std:d min:d q1:d median:d q3:d max:d"


@query(f"scenario:s {DESCRIBE}", "select scenario, count(mean_temp_c) n, avg(mean_temp_c) mean, stddev_samp(mean_temp_c) std, min(mean_temp_c) min, quantile_cont(mean_temp_c, 0.25) q1, quantile_cont(mean_temp_c, 0.5) median, quantile_cont(mean_temp_c, 0.75) q3, max(mean_temp_c) max from county_year group by all", COUNTY_YEAR)
def describe(spark, sf_dir):
    """With the sample deviation."""
    return summary.describe(county_year(spark, sf_dir), "mean_temp_c", "scenario")


@query(DESCRIBE, "select count(tas) n, avg(tas) mean, stddev_pop(tas) std, min(tas) min, quantile_cont(tas, 0.25) q1, quantile_cont(tas, 0.5) median, quantile_cont(tas, 0.75) q3, max(tas) max from obs", OBS)
def grid_statistics(spark, sf_dir):
    """With the population deviation."""
    return summary.describe(obs(spark, sf_dir), "tas", population=True)


@query("scenario:s rows:i with_data:i without_data:i", 'select scenario, count(*) "rows", count(annual_precip_mm) with_data, count_if(annual_precip_mm is null) without_data from county_year group by all', COUNTY_YEAR)
def coverage(spark, sf_dir):
    """A34."""
    return summary.coverage(county_year(spark, sf_dir), "annual_precip_mm", "scenario")


@query("dimension:s key:s total:i completed:i failed:i rate:d", """select dimension, key, count(*) total, count_if(status = 'completed') completed, count_if(status = 'failed') failed, 100.0 * count_if(status = 'completed') / count(*) rate from
    (select status, unnest(['stage', 'region', 'variable', 'overall']) dimension, unnest([stage, region, variable, 'all']) key from files) group by all""", FILES)  # fmt: skip
def task_status(spark, sf_dir):
    """By stage, region, variable and overall."""
    return summary.task_status(files(spark, sf_dir))


@query("status:s tasks:i", "select status, count(*) tasks from files group by all", FILES)
def status_counts(spark, sf_dir):
    """By status."""
    return summary.status_counts(files(spark, sf_dir))


@query("total:i completed:i failed:i success_rate:d mean_seconds:d throughput:d", "select count(*) total, count_if(status = 'completed') completed, count_if(status = 'failed') failed, 100.0 * count_if(status = 'completed') / count(*) success_rate, avg(seconds) mean_seconds, count(*) / sum(seconds) throughput from files", FILES)
def run_summary(spark, sf_dir):
    """A38, A39, A42."""
    return summary.run_summary(files(spark, sf_dir))


@query("workers:i seconds:d speedup:d efficiency:d", "select workers, s as seconds, one / s speedup, one / s / workers efficiency from (select id % 4 + 1 workers, avg(seconds) s from files group by all), (select avg(seconds) one from files where id % 4 = 0)", FILES)
def worker_speedup(spark, sf_dir):
    """Mean times by number of workers, against one worker."""
    return summary.speedup(files(spark, sf_dir).groupBy((F.col("id") % 4 + 1).alias("workers")).agg(F.avg("seconds").alias("seconds")))


@query("expected:i existing:i readable:i existence_rate:d readability_rate:d passed:b", """select e expected, x existing, r readable, x / e existence_rate, r / x readability_rate, x / e >= 0.95 and r / x >= 0.9 passed from
    (select count(*) e, count(size) x, count_if(size > 0) r from (select distinct path from files) left join (select path, max(case when status = 'pending' then 0 else size end) size from files where status <> 'failed' and "year" > 1995 group by path) using (path))""", FILES)  # fmt: skip
def availability_rates(spark, sf_dir):
    """Q16: which expected files are there, and which of them hold anything."""
    f = files(spark, sf_dir)
    listing = f.where("status <> 'failed' and year > 1995").groupBy("path").agg(F.max(F.when(F.col("status") == "pending", 0).otherwise(F.col("size"))).alias("size"))
    return catalog.availability_rates(f, listing)


@query("extension:s files:i bytes:i small:i", "select ['nc', 'csv', 'parquet'][id % 3 + 1] extension, count(*) files, sum(size) bytes, count_if(size < 100000) small from files group by all", FILES)
def output_summary(spark, sf_dir):
    """Q17: files by format, and how many are suspiciously small."""
    ending = F.element_at(F.array(F.lit(".NC"), F.lit(".csv"), F.lit(".parquet")), (F.col("id") % 3 + 1).cast("int"))
    return catalog.output_summary(files(spark, sf_dir).withColumn("path", F.concat("path", ending)), 100_000)


LATEST = FILES + """, latest as (select * from (select stage, region, variable, scenario, status, row_number() over (partition by stage, region, variable, scenario order by o_orderdate desc, list_position(['pending', 'running', 'failed', 'completed'], status) desc) n
    from files join orders on id = o_orderkey) where n = 1)"""


def events(spark, sf_dir):
    """Task events, one an order."""
    at = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"))
    return files(spark, sf_dir).join(at, "id").select("stage", "region", "variable", "scenario", "status", "at")


@query("stage:s region:s variable:s scenario:s status:s", "select * exclude (n) from latest", LATEST)
def latest_tasks(spark, sf_dir):
    """The latest event of each task."""
    return latest(events(spark, sf_dir))


@query("stage:s region:s variable:s scenario:s status:s", "select * exclude (n) from latest where status in ('pending', 'failed') and region = 'AK' and variable = 'tas'", LATEST)
def pending_tasks(spark, sf_dir):
    """tasks left to do, filtered."""
    return pending(latest(events(spark, sf_dir)), region="AK", variable="tas")


@query("kind:s series:i", """select case when n >= 365 then 'daily' when n = 12 then 'monthly' when n = 4 then 'seasonal' else 'annual' end kind, count(*) series from (select county, count(distinct doy) n from obs where doy < 366 group by county, "year", scenario) group by all""", OBS)
def climatology_kinds(spark, sf_dir):
    """What a table's number of distinct days makes it."""
    from stratus.functions import expr

    days = obs(spark, sf_dir).where("doy < 366").groupBy("county", "year", "scenario").agg(F.count_distinct("doy").alias("n"))
    return days.groupBy(expr.climatology_kind(F.col("n")).alias("kind")).agg(F.count("*").alias("series"))


@query("geoid:s rings:i points:i area:d", "select geoid, 1 rings, 4 points, 2 * r * r area from counties", COUNTIES)
def repaired_rings(spark, sf_dir):
    """Q24: diamonds that run clockwise, with a point twice, a closing point and a second ring without an area."""
    x, y, r = F.col("x"), F.col("y"), F.col("r")
    corners = [F.struct((x + a * r).alias("lon"), (y + b * r).alias("lat")) for a, b in ((-1, 0), (0, 1), (0, 1), (1, 0), (0, -1), (-1, 0))]
    c = counties(spark, sf_dir).select("geoid", spatial.repaired(F.array(F.array(*corners), F.array(*corners[:2]))).alias("rings"))
    return c.select("geoid", F.size("rings").alias("n"), F.size(F.col("rings")[0]).alias("points"), spatial.ring_area(F.col("rings")[0]).alias("area")).withColumnRenamed("n", "rings")


@query("geoid:s lon:d lat:d parts:i valid:b", "select geoid, x + 0.6875 * r lon, y lat, 2 parts, true valid from counties", COUNTIES)
def centroids_with_holes(spark, sf_dir):
    """Q24, Q25: diamonds with a hole that runs like its shell, and a second part that runs the other way."""

    def diamond(x, y, r, turned=False):
        points = [F.struct((x + a * r).alias("lon"), (y + b * r).alias("lat")) for a, b in ((-1, 0), (0, -1), (1, 0), (0, 1))]
        return F.array(*(points[::-1] if turned else points))

    c = counties(spark, sf_dir)
    x, y, r = F.col("x"), F.col("y"), F.col("r")
    rings = F.array(diamond(x, y, r), diamond(x + r / 4, y, r / 2), diamond(x + 3 * r, y, r / 2, True))
    middle = spatial.centroid(F.col("rings"))
    return c.select("geoid", rings.alias("rings")).select("geoid", middle["lon"].alias("lon"), middle["lat"].alias("lat"), F.size(spatial.parts(F.col("rings"))).alias("parts"), spatial.is_valid(F.col("rings")).alias("valid"))


@query("region:s variable:s found:i missing:s percent:d", """select region, variable, count(distinct "year") found, (select coalesce(string_agg(cast(y as varchar), ',' order by y), '') from range(1990, 2006) r(y) where not list_contains(list(distinct "year"), y)) missing, 100.0 * count(distinct "year") / 16 percent
    from files where "year" between 1990 and 2005 group by all""", FILES)  # fmt: skip
def year_coverage(spark, sf_dir):
    """A37, U4, U5."""
    c = summary.year_coverage(files(spark, sf_dir), 1990, 2005, "region", "variable")
    return c.withColumn("missing", F.concat_ws(",", F.transform("missing", lambda y: y.cast("string"))))


@query("variable:s scenario:s first_year:i last_year:i", 'select variable, scenario, min("year") first_year, max("year") last_year from files group by all', FILES)
def file_availability(spark, sf_dir):
    """S7."""
    return catalog.availability(files(spark, sf_dir))


@query("first_year:i last_year:i", """select coalesce(min("year"), 0) first_year, coalesce(max("year"), 0) last_year from files where variable = 'tas' and scenario = 'ssp245'
    union all select coalesce(min("year"), 0), coalesce(max("year"), 0) from files where variable = 'tas' and scenario = 'ssp126'""", FILES)  # fmt: skip
def available_years(spark, sf_dir):
    """With and without files."""
    f = files(spark, sf_dir)
    return catalog.available_years(f, "tas", "ssp245").union(catalog.available_years(f, "tas", "ssp126"))


@query("id:i year:i", """select id, "year" from files where variable = 'tas' and scenario = 'historical' and "year" between 1995 and 1996""", FILES)
def files_for_period(spark, sf_dir):
    """S5, F6, T1."""
    return catalog.files_for_period(files(spark, sf_dir), "tas", "historical", 1995, 1996)


@query("id:i year:i scenario:s", """select id, "year", scenario from files where variable = 'pr' and "year" between 1996 and 1999 and (scenario = 'historical' and "year" <= 1997 or scenario = 'ssp585' and "year" > 1997)""", FILES)
def hybrid_files(spark, sf_dir):
    """S9, U2."""
    return catalog.hybrid_files(files(spark, sf_dir), "pr", "ssp585", 1996, 1999, 1997)


@query("id:i year:i scenario:s", 'select id, "year", scenario from files', FILES)
def metric_inputs(spark, sf_dir):
    """Year and scenario from the file name alone."""
    return catalog.metric_inputs(files(spark, sf_dir).select("id", "path", F.lit(None).cast("int").alias("year")))


@query("region:s variable:s years:s", """select region, variable, string_agg(distinct cast("year" as varchar), ',' order by cast("year" as varchar)) as years from files group by all""", FILES)
def discovered_data(spark, sf_dir):
    """S11."""
    return catalog.discovered(files(spark, sf_dir)).withColumn("years", F.concat_ws(",", F.transform("years", lambda y: y.cast("string"))))


@query("scenario:s year:i", """select scenario, "year" from (select 'historical' scenario, unnest(range(1990, 1998)) "year" union all select 'ssp245', unnest(range(1998, 2006))) except select scenario, "year" from files where variable = 'pr'""", FILES)
def missing_files(spark, sf_dir):
    """S12, J7, J10."""
    expected = catalog.expected_years(spark, {"historical": (1990, 1997), "ssp245": (1998, 2005)})
    return catalog.missing_files(files(spark, sf_dir).where("variable = 'pr'"), expected)


@query("path:s year:i", 'select path, "year" from files where "year" = 1999 order by path limit 1', FILES)
def first_file_of_year(spark, sf_dir):
    """S13."""
    return catalog.first_of_year(files(spark, sf_dir), 1999)


@query("id:i quality:d total:i has_more:b", """select id, quality, n total, true has_more from files, (select count(*) n from files where variable in ('pr', 'tas') and region = 'AK' and "year" between 1996 and 2000 and quality >= 0.5)
    where variable in ('pr', 'tas') and region = 'AK' and "year" between 1996 and 2000 and quality >= 0.5 order by quality desc, id limit 20 offset 10""", FILES)  # fmt: skip
def catalog_page(spark, sf_dir):
    """S20, T9."""
    return catalog.catalogue_page(files(spark, sf_dir), ("pr", "tas"), ("AK",), years=(1996, 2000), min_quality=0.5, order="quality", descending=True, limit=20, offset=10)


@query("region:s variable:s files:i scenarios:s first_year:i last_year:i", """select region, variable, count(*) files, string_agg(distinct scenario, ',' order by scenario) scenarios, min("year") first_year, max("year") last_year from files group by all""", FILES)
def data_summary(spark, sf_dir):
    """S21."""
    return catalog.data_summary(files(spark, sf_dir)).withColumn("scenarios", F.concat_ws(",", "scenarios"))


@query("region:s variable:s files:i", """select r region, v "variable", count(f.id) as files from (select unnest(['CONUS', 'AK', 'HI', 'PRVI', 'GU']) r) cross join (select unnest(['pr', 'tas', 'tasmax', 'tasmin']) v) left join files f on f.region = r and f."variable" = v group by all""", FILES)
def valid_pairs(spark, sf_dir):
    """Every valid pair, and its files."""
    from stratus.regions import valid_pairs as pairs

    return pairs(spark).join(files(spark, sf_dir).groupBy("region", "variable").agg(F.count("*").alias("files")), ["region", "variable"], "left").fillna(0, ["files"])


@query("id:i path_ok:b quality_ok:b ready:b", "select id, true path_ok, quality between 0 and 1 quality_ok, status = 'completed' and quality >= 0.95 ready from files", FILES)
def contract_checks(spark, sf_dir):
    """Q20, Q23."""
    f = files(spark, sf_dir).withColumns({"valid": F.lit(True), "compatible": F.lit(True), "file_exists": F.lit(True), "quality_score": F.col("quality")})
    return f.select("id", contracts.valid_relative_path(F.col("path")).alias("path_ok"), F.col("quality").between(0, 1).alias("quality_ok"), contracts.ready_for_metrics(f).alias("ready"))


@query("rows:i missing_percent:d below:i above:i values_ok:b missing_ok:b coordinates_ok:b", 'select count(*) "rows", 0.0 missing_percent, count_if(tas < 200) below, count_if(tas > 350) above, true values_ok, true missing_ok, true coordinates_ok from obs', OBS)
def grid_checks(spark, sf_dir):
    """Q15."""
    return contracts.grid_checks(obs(spark, sf_dir), "tas", "tas")


@query("lat_min:d lat_max:d lon_min:d lon_max:d step_lat:d step_lon:d valid:b", "select min(lat) lat_min, max(lat) lat_max, min(lon) lon_min, max(lon) lon_max, (max(lat) - min(lat)) / (count(distinct lat) - 1) step_lat, (max(lon) - min(lon)) / (count(distinct lon) - 1) step_lon, true valid from obs", OBS)
def coordinate_checks(spark, sf_dir):
    """Q19."""
    return contracts.coordinate_checks(obs(spark, sf_dir))


@query("geoid:s lat:d lon:d", "select geoid, lat, lon from counties join cells on abs(lon - x) + abs(lat - y) < r - 1e-9", f"{COUNTIES}, {CELLS}")
def point_in_polygon(spark, sf_dir):
    """Cell centres inside diamonds, whose test is a sum of distances."""
    return spatial.cells_in_counties(counties(spark, sf_dir), cells(spark, sf_dir))


@query("geoid:s cells:i mean:d", "select geoid, count(*) cells, avg(value) mean from counties join cells on lon between x - r - 0.1 and x + r + 0.1 and lat between y - r - 0.1 and y + r + 0.1 group by all", f"{COUNTIES}, {CELLS}")
def box_join(spark, sf_dir):
    """Cells in widened boxes."""
    c = counties(spark, sf_dir).withColumn("bbox", spatial.bbox(F.col("rings")))
    return spatial.cells_in_boxes(c, cells(spark, sf_dir)).groupBy("geoid").agg(F.count("*").alias("cells"), F.avg("value").alias("mean"))


NEAR = """near as (select geoid, (select arg_min(a, (abs(a - y), a)) from (select distinct lat a from cells)) la, (select arg_min(a, (abs(a - x), a)) from (select distinct lon a from cells)) lo, x, y from counties
  where x between (select min(lon) from cells) and (select max(lon) from cells) and y between (select min(lat) from cells) and (select max(lat) from cells))"""


@query("geoid:s near_lat:d near_lon:d", "select geoid, la near_lat, lo near_lon from near where abs(la - y) <= 0.75 and abs(lo - x) <= 0.75", f"{COUNTIES}, {CELLS}, {NEAR}")
def nearest_cell(spark, sf_dir):
    """The nearest latitude and longitude by axis."""
    points = counties(spark, sf_dir).select("geoid", F.col("x").alias("lon"), F.col("y").alias("lat"))
    return spatial.nearest_axes(points, cells(spark, sf_dir))


@query("geoid:s value:d pixel_count:i is_nearest:b", """select geoid, coalesce(i.v, n.v) value, coalesce(i.n, case when n.v is not null then 1 end, 0) pixel_count, i.n is null and n.hit is not null is_nearest from counties
    left join (select geoid, avg(value) v, count(*) n from counties join cells on abs(lon - x) + abs(lat - y) < r - 1e-9 where value is not null group by all) i using (geoid)
    left join (select geoid, value v, true hit from near join cells on lat = la and lon = lo where abs(la - y) <= 0.75 and abs(lo - x) <= 0.75) n using (geoid)""", f"{COUNTIES}, {CELLS}, {NEAR}")  # fmt: skip
def zonal_mean(spark, sf_dir):
    """J1 with J2: one row a county, the nearest cell where none lies inside."""
    return spatial.zonal_mean(counties(spark, sf_dir).select("geoid", "rings"), cells(spark, sf_dir))


@query("geoid:s lon:d lat:d area:d valid:b", "select geoid, x lon, y lat, 2 * r * r area, true valid from counties", COUNTIES)
def centroids(spark, sf_dir):
    """Q24, Q25."""
    c = spatial.centroid(F.col("rings"))
    return counties(spark, sf_dir).select("geoid", c["lon"].alias("lon"), c["lat"].alias("lat"), F.abs(spatial.ring_area(F.col("rings")[0])).alias("area"), spatial.is_valid(F.col("rings")).alias("valid"))


@query("geoid:s", "select distinct county geoid from obs where county[1:2] in ('02', '15')", OBS)
def counties_of_regions(spark, sf_dir):
    """Counties of two regions, each once."""
    c = obs(spark, sf_dir).select(F.col("county").alias("geoid"))
    return spatial.counties_of_region(c, "AK", "HI")


@query("scenario:s first_year:i last_year:i years:i files:i inside:i", """with model as (select unnest(['historical', 'ssp126', 'ssp245', 'ssp370', 'ssp585']) s, unnest([1850, 2015, 2015, 2015, 2015]) a, unnest([2014, 2100, 2100, 2100, 2100]) b)
    select s scenario, a first_year, b last_year, b - a + 1 as years, count(f.id) as files, coalesce(count_if(f."year" between a and b), 0) inside from model left join files f on f.scenario = s group by all""", FILES)
def model_scenarios(spark, sf_dir):
    """Scenarios of a registered model with their years, their files and how many of these lie within."""
    from stratus.regions import scenarios_frame

    yearly = files(spark, sf_dir).groupBy("scenario", "year").agg(F.count("*").alias("n"))
    joined = scenarios_frame(spark, "noresm2").join(yearly, "scenario", "left").groupBy("scenario", "first_year", "last_year")
    counts = joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("files"), F.coalesce(F.sum(F.when(F.col("year").between(F.col("first_year"), F.col("last_year")), F.col("n"))), F.lit(0)).alias("inside"))
    return counts.withColumn("years", F.size(F.sequence("first_year", "last_year")))


@query("region:s width:d height:d valid:b cells:i", """with boxes as (select unnest(['CONUS', 'AK', 'HI', 'PRVI', 'GU']) region, unnest([234.0, 170.0, 181.63, 292.03, 144.58]) x0, unnest([294.0, 235.0, 205.2, 295.49, 146.12]) x1, unnest([24.0, 50.0, 18.92, 17.62, 13.18]) y0, unnest([50.0, 72.0, 28.45, 18.57, 20.61]) y1)
    select region, x1 - x0 width, y1 - y0 height, true valid, count(c.cell_id) cells from boxes left join (select distinct cell_id, lat, lon from obs) c on c.lon between x0 and x1 and c.lat between y0 and y1 group by all""", OBS)
def region_definitions(spark, sf_dir):
    """The regions, whether their bounds are in order, and their cells."""
    from stratus.functions.expr import in_region
    from stratus.regions import REGIONS, regions_frame

    ok = F.col("lat_min").between(-90, 90) & (F.col("lat_min") < F.col("lat_max")) & F.col("lon_min").between(0, 360) & F.col("lon_max").between(0, 360)
    inside = F.array_compact(F.array(*[F.when(in_region(F.col("lat"), F.col("lon"), r), key) for key, r in REGIONS.items()]))
    held = obs(spark, sf_dir).select("cell_id", "lat", "lon").distinct().select(F.explode(inside).alias("region")).groupBy("region").agg(F.count("*").alias("cells"))
    return regions_frame(spark).join(held, "region", "left").select("region", (F.col("lon_max") - F.col("lon_min")).alias("width"), (F.col("lat_max") - F.col("lat_min")).alias("height"), ok.alias("valid"), F.coalesce("cells", F.lit(0)).alias("cells"))


@query("id:i dataset:s valid:b", """select id, variable || '_' || region || '_' || scenario || '_' || cast("year" as varchar) dataset, true valid from files""", FILES)
def dataset_ids(spark, sf_dir):
    """Q22: ids have the form and name their parts."""
    f = files(spark, sf_dir)
    parts = [F.col(c) for c in ("variable", "region", "scenario", "year")]
    name = contracts.dataset_id(*parts)
    return f.select("id", name.alias("dataset"), contracts.valid_id(name, *parts).alias("valid"))


@query("id:i year_ok:b window_ok:b", 'select id, true year_ok, id % 2 = 0 window_ok from files', FILES)
def window_checks(spark, sf_dir):
    """Q20: years and windows of the right length that hold their target."""
    f, y = files(spark, sf_dir), F.col("year")
    start = F.when(F.col("id") % 2 == 0, y - 29).otherwise(y - 30)
    return f.select("id", contracts.valid_year(y).alias("year_ok"), contracts.valid_window(start, y, y).alias("window_ok"))


@query("region:s tasks:i", """select r region, n tasks from (select unnest(['CONUS', 'AK', 'HI', 'PRVI', 'GU']) r), (select count(*) n from files where scenario = 'historical' and "year" <= 2014 or scenario in ('ssp245', 'ssp585') and "year" >= 2015)""", FILES)
def processing_tasks(spark, sf_dir):
    """Section 2.16: every file with every region."""
    from stratus.regions import regions_frame

    t = catalog.processing_tasks(files(spark, sf_dir).drop("region"), regions_frame(spark))
    return t.groupBy("region").agg(F.count("*").alias("tasks"))


@query("variable:s scenario:s year:i", """select distinct variable, scenario, "year" from files where "year" between 1996 and 1999 except select distinct variable, scenario, "year" from files where status = 'completed' and region = 'AK' and quality >= 0.98""", FILES)
def outputs_to_make(spark, sf_dir):
    """Planned outputs that do not exist yet."""
    from stratus.sources.sinks import only_missing

    f, keys = files(spark, sf_dir), ("variable", "scenario", "year")
    return only_missing(f.where("year between 1996 and 1999").select(*keys).distinct(), f.where("status = 'completed' and region = 'AK' and quality >= 0.98"), keys)


@query("cell_id:i lat:d lon:d", "select distinct cell_id, 24 + (cell_id % 27) * (26.0 / 26) lat, (234 + (cell_id % 61) * (60.0 / 60)) - 360 lon from obs", OBS)
def index_to_degrees(spark, sf_dir):
    """Grid indices scaled to a region's box and turned to -180..180."""
    from stratus.functions.expr import geographic
    from stratus.regions import region

    i = obs(spark, sf_dir).select("cell_id", (F.col("cell_id") % 27).alias("lat"), (F.col("cell_id") % 61).alias("lon")).distinct()
    return geographic(i, region("CONUS"), 27, 61, indexed=True, is_360=False)


@query("county:s state:s region:s", """select distinct county, county[1:2] state, case county[1:2] when '02' then 'AK' when '15' then 'HI' when '72' then 'PRVI' when '78' then 'PRVI' when '66' then 'GU' when '69' then 'GU' else 'CONUS' end region from obs""", OBS)
def county_regions(spark, sf_dir):
    """State and region of a county."""
    from stratus.functions.expr import region_of_state, state_of

    s = state_of(F.col("county"))
    return obs(spark, sf_dir).select("county", s.alias("state"), region_of_state(s).alias("region")).distinct()


@query("geoid:s", "select geoid from counties where x - r >= 2 and x + r <= 15 and y - r >= 0 and y + r <= 9", COUNTIES)
def counties_inside(spark, sf_dir):
    """counties whose boxes lie in a larger one."""
    b = F.col("bbox")
    c = counties(spark, sf_dir).withColumn("bbox", spatial.bbox(F.col("rings")))
    return c.where((b["minx"] >= 2) & (b["maxx"] <= 15) & (b["miny"] >= 0) & (b["maxy"] <= 9))


@query("geoid:s", "select geoid from counties order by md5(geoid || ':42'), geoid limit 20", COUNTIES)
def county_sample(spark, sf_dir):
    """twenty counties, always the same for a seed."""
    return spatial.sample_counties(counties(spark, sf_dir), 20)


@query("geoid:s cells:i", """select geoid, count(*) cells from counties join (select c.lat, c.lon, y1 - (dense_rank() over (order by lat) - 0.5) * (y1 - y0) / ny py, x0 + (dense_rank() over (order by lon) - 0.5) * (x1 - x0) / nx px from cells c,
    (select min(lat) y0, max(lat) y1, count(distinct lat) ny, min(lon) x0, max(lon) x1, count(distinct lon) nx from cells)) on abs(px - x) + abs(py - y) < r - 1e-9 group by all""", f"{COUNTIES}, {CELLS}")  # fmt: skip
def legacy_mask(spark, sf_dir):
    """J1 with the mask that runs from north to south (B1, B2)."""
    return spatial.cells_in_counties(counties(spark, sf_dir), cells(spark, sf_dir), mask="legacy").groupBy("geoid").agg(F.count("*").alias("cells"))


@query("picked:s mean:d", """select 'tas' picked, avg(tas) mean from obs union all select 'air_temperature', avg(tas) from obs union all select 'pr_flux', avg(pr) from obs""", OBS)
def variable_columns(spark, sf_dir):
    """C11: the column that holds a variable, in tables that name it differently."""
    from functools import reduce

    from stratus.functions.expr import PRECIPITATION_COLUMNS, TEMPERATURE_COLUMNS, pick_column

    rows = obs(spark, sf_dir)
    tables = ((rows.select("tas", "lat"), TEMPERATURE_COLUMNS), (rows.select("lat", F.col("tas").alias("air_temperature")), TEMPERATURE_COLUMNS), (rows.select("lon", F.col("pr").alias("pr_flux")), PRECIPITATION_COLUMNS))
    made = [df.agg(F.avg(pick_column(df.columns, names)).alias("mean")).select(F.lit(pick_column(df.columns, names)).alias("picked"), "mean") for df, names in tables]
    return reduce(lambda a, b: a.unionByName(b), made)
