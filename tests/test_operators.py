"""Small frames with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from stratus.functions import expr
from stratus.operators import climatology, contracts, metrics, outliers, quality, spatial, summary
from stratus.regions import REGIONS, is_valid, model, region
from stratus.schema import nan_to_null, standard_names, with_geoid

CY = "geoid string, year int, scenario string, mean_temp_c double, min_temp_c double, max_temp_c double, annual_precip_mm double, precip_gt_50mm double, precip_gt_100mm double, pixel_count bigint"


def one(df):
    return df.collect()[0]


def county(spark, rows):
    return spark.createDataFrame(rows, CY)


def test_nan_becomes_null_and_names_are_standard(spark):
    df = nan_to_null(spark.createDataFrame([(1, float("nan")), (2, 3.0)], "k int, v double"))
    assert [r.v for r in df.orderBy("k").collect()] == [None, 3.0]
    df = with_geoid(standard_names(spark.createDataFrame([(1001, 2.0)], "GEOID int, annual_mean_temp_c double")))
    assert one(df).asDict() == {"geoid": "01001", "mean_temp_c": 2.0}


def test_values_that_are_not_finite_spoil_their_own_windows(spark):
    odd = {1960: float("inf"), 1995: -float("inf"), 2011: float("nan")}
    rows = [("tas", y, 1, 0.0, 0.0, odd.get(y, 1.0)) for y in range(1950, 2060)]
    daily = climatology.daily_climatology(spark.createDataFrame(rows, "variable string, year int, doy int, lat double, lon double, value double"), "value", ("variable", "year"), "calendar")
    got = {r.target_year: r.value for r in climatology.climate_normal(daily, 30, 25).collect()}
    for target, value in got.items():
        held = [odd.get(y, 1.0) for y in range(max(1950, target - 29), min(2059, target) + 1)]
        plain = sum(held) / len(held)
        assert value == plain or (value != value and plain != plain), target
    assert {str(v) for v in got.values()} == {"inf", "nan", "-inf", "1.0"} and len(got) > 80


def test_longitudes(spark):
    df = spark.createDataFrame([(0.0,), (180.0,), (180.5,), (359.0,)], "x double")
    got = [(r[0], r[1]) for r in df.select(expr.lon_180(F.col("x")), expr.lon_360(expr.lon_180(F.col("x")))).collect()]
    assert got == [(0.0, 0.0), (180.0, 180.0), (-179.5, 180.5), (-1.0, 359.0)]


def test_box_edges_are_inside_and_the_date_line_wraps(spark):
    df = spark.createDataFrame([(24.0, 234.0), (50.0, 294.0), (23.9, 250.0), (30.0, 294.1)], "lat double, lon double")
    assert climatology.region_box(df, REGIONS["CONUS"]).count() == 2
    ak = spark.createDataFrame([(60.0, 175.0), (60.0, -150.0), (60.0, -100.0), (60.0, 160.0)], "lat double, lon double")
    assert climatology.region_box(ak, REGIONS["AK"], is_360=False).count() == 2


def test_leap_days(spark):
    df = spark.createDataFrame([(2000, 59), (2000, 60), (2000, 61), (2000, 366), (2001, 60), (2001, 365), (1900, 60)], "year int, doy int")
    assert sorted((r.year, r.doy) for r in expr.leap_365(df).collect()) == [(1900, 60), (2000, 59), (2000, 60), (2000, 365), (2001, 60), (2001, 365)]


def test_years_of_names(spark):
    names = ["tas_day_NorESM2-LM_historical_r1i1p1f1_gn_1995_v1.1.nc", "a/b_2001.nc", "x_1999", "run1987b.txt", "none.nc", "n_9999.nc"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r[0] for r in df.select(expr.year_of_name(F.col("p"))).collect()] == [1995, 2001, 1999, 1987, None, None]


def test_model_file_names_round_trip(spark):
    from stratus.sources.catalog import with_metadata

    m = model("noresm2")
    name = m.file_name("pr", "ssp245", 2030, "1.1")
    r = one(with_metadata(spark.createDataFrame([(name,)], "path string")))
    assert (r.variable, r.scenario, r.year, r.version, r.grid) == ("pr", "ssp245", 2030, "1.1", "gn")
    with pytest.raises(KeyError):
        model("no-such-model")
    with pytest.raises(KeyError):
        m.file_name("pr", "ssp119", 2030)


def test_highest_version_wins(spark):
    rows = [("tas", "historical", 2000, "1.9", "a"), ("tas", "historical", 2000, "1.10", "b"), ("tas", "historical", 2000, None, "c")]
    df = spark.createDataFrame(rows, "variable string, scenario string, year int, version string, path string")
    assert [r.path for r in climatology.latest_versions(df).collect()] == ["b"]


def test_years_weigh_the_same_and_too_few_years_give_nothing(spark):
    rows = [(y, d, 0.0, 0.0, v) for y, d, v in ((2001, 1, 1.0), (2001, 1, 3.0), (2002, 1, 10.0), (2005, 1, 7.0))]
    df = spark.createDataFrame(rows, "year int, doy int, lat double, lon double, value double")
    daily = climatology.daily_climatology(df, "value", ("year",))
    got = {r.target_year: (r.value, r.num_years, r.source_start, r.source_end) for r in climatology.climate_normal(daily, 3, 2, ()).collect()}
    assert got == {2002: (6.0, 2, 2001, 2002), 2003: (6.0, 2, 2001, 2002)}


def test_windows_are_not_shuffled(spark):
    rows = spark.createDataFrame([(2001, 1, 0.0, 0.0, 1.0)], "year int, doy int, lat double, lon double, value double")
    daily = climatology.daily_climatology(rows, "value", ("year",))
    plan = climatology.climate_normal(daily, keys=(), readings=rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doy") == 1 and "hashpartitioning(target_year#" not in plan.split("BroadcastExchange")[0]


def test_cells_tell_coordinates_apart(spark):
    df = spark.createDataFrame([(-90.0, -180.0), (90.0, 360.0), (0.000001, 0.0), (0.0, 0.000001), (0.0, 0.0)], "lat double, lon double")
    assert climatology.with_cell(df).select("cell").distinct().count() == 5


@pytest.mark.parametrize("years,kept", [(24, 0), (25, 6), (30, 11)])
def test_production_window(spark, years, kept):
    daily = climatology.with_cell(spark.range(years).select((F.col("id") + 1980).cast("int").alias("year"), F.lit(1).alias("doy"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.lit(1.0).alias("value")))
    assert climatology.climate_normal(daily, keys=()).count() == kept


def test_hybrid_prefers_history(spark):
    files = spark.createDataFrame([("historical", 2014), ("ssp245", 2014), ("ssp245", 2015), ("ssp585", 2016)], "scenario string, year int")
    targets = spark.createDataFrame([(2016,)], "target_year int")
    assert {r.scenario: r.files for r in climatology.hybrid_sources(files, targets).collect()} == {"historical": 1, "ssp245": 1}


def test_period_plan(spark):
    plan = climatology.period_plan(spark)
    assert plan.where("period_type = 'historical'").count() == 35
    assert plan.where("scenario = 'ssp245'").count() == 30 + 56
    assert one(plan.where("period_type = 'historical' and target_year = 1980")).start_year == 1951


def test_metrics_with_nulls(spark):
    rows = [("c", 1, 12.0), ("c", 1, 8.0), ("c", 1, None), ("c", 2, None), ("c", 3, 20.0)]
    df = spark.createDataFrame(rows, "geoid string, cell int, tas double")
    cells = metrics.cell_metrics(df, ["mean_temp_c", "growing_degree_days"], ("geoid", "cell"))
    assert {r.cell: (r.mean_temp_c, r.growing_degree_days) for r in cells.collect()} == {1: (10.0, 2.0), 2: (None, None), 3: (20.0, 10.0)}
    got = {r.metric: (r.value, r.pixel_count) for r in metrics.county_metrics(cells, ["mean_temp_c", "growing_degree_days"], ("geoid",)).collect()}
    assert got == {"mean_temp_c": (15.0, 2), "growing_degree_days": (6.0, 2)}
    zero = metrics.cell_metrics(df, ["growing_degree_days"], ("geoid", "cell"), nan_as_zero=True)
    assert {r.cell: r.growing_degree_days for r in zero.collect()} == {1: 2.0, 2: 0.0, 3: 10.0}


def test_thresholds_are_strict_and_linear(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(11)], "cell int, tasmax double")
    r = metrics.cell_metrics(df, ["high_temp_days_p90"], ()).collect()[0]
    assert (r.high_temp_days_p90, r.p90_tasmax) == (1, 9.0)


@pytest.mark.parametrize("q", [0.0, 0.013, 0.5, 0.9, 1.0])
def test_quantiles_are_exact(spark, q, monkeypatch):
    import numpy as np

    monkeypatch.setattr(metrics, "BAND_ROWS", 50)
    values = [float(v) for v in np.random.default_rng(1).integers(0, 400, 5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert metrics.exact_quantiles(df, {"x": ("v", q)})["x"] == pytest.approx(float(np.quantile(values, q)))


def test_several_quantiles_at_once_and_empty_columns(spark, monkeypatch):
    monkeypatch.setattr(metrics, "BAND_ROWS", 3)
    df = spark.createDataFrame([(None, 2.0, 1.0), (None, 4.0, None), (None, 4.0, 3.0), (None, 8.0, 5.0)], "e double, a double, b double")
    got = metrics.exact_quantiles(df, {"e": ("e", 0.5), "a50": ("a", 0.5), "a90": ("a", 0.9), "b": ("b", 0.25)})
    assert got == {"e": None, "a50": 4.0, "a90": pytest.approx(6.8), "b": 2.0}
    assert metrics.exact_quantiles(df, {}) == {} and metrics.exact_quantiles(df.limit(0), {"a": ("a", 0.5)}) == {"a": None}


def test_box_statistics_of_one_value(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", None)], "geoid string, v double")
    rows = metrics.box_statistics(df, "v", ("geoid",), (5, 95)).collect()
    assert [(r.geoid, r.num_grid_points, r["std"], r.p5, r.p95) for r in rows] == [("a", 1, 0.0, 3.0, 3.0)]


def test_quantile_of_all_metrics_wide(spark):
    df = spark.createDataFrame([("c", 1, 1.0), ("c", 1, 2.0)], "geoid string, cell int, pr double")
    names = ["annual_precip_mm", "wet_days_p95"]
    w = metrics.wide(metrics.county_metrics(metrics.cell_metrics(df, names, ("geoid", "cell")), names, ("geoid",)), names, ("geoid",))
    r = one(w)
    assert (r.annual_precip_mm_value, r.wet_days_p95_value, r.annual_precip_mm_threshold) == (3.0, 1.0, None)


SQUARE = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]]
HOLE = [*SQUARE, [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0)]]
TWO = [*SQUARE, [(10.0, 0.0), (12.0, 0.0), (12.0, 2.0), (10.0, 2.0)]]


def shapes(spark, **rings):
    rows = [(g, [[{"lon": x, "lat": y} for x, y in ring] for ring in r]) for g, r in rings.items()]
    return spark.createDataFrame(rows, "geoid string, rings array<array<struct<lon:double,lat:double>>>")


def grid(spark, n=14, step=1.0, offset=0.5):
    i = F.col("id")
    return spark.range(n * n).select((F.floor(i / n) * step + offset).alias("lat"), ((i % n) * step + offset).alias("lon"), i.cast("double").alias("value"))


def test_containment(spark):
    got = spatial.cells_in_counties(shapes(spark, square=SQUARE, hole=HOLE, two=TWO), grid(spark))
    assert {r.geoid: r.n for r in got.groupBy("geoid").agg(F.count("*").alias("n")).collect()} == {"square": 16, "hole": 12, "two": 20}


def test_centroids_and_validity(spark):
    c = spatial.centroid(F.col("rings"))
    got = {r.geoid: (r.lon, r.lat) for r in shapes(spark, square=SQUARE, hole=HOLE).select("geoid", c["lon"].alias("lon"), c["lat"].alias("lat")).collect()}
    assert got == {"square": (2.0, 2.0), "hole": (2.0, 2.0)}
    flat = shapes(spark, flat=[[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]], few=[[(0.0, 0.0), (1.0, 1.0)]], good=SQUARE)
    assert {r[0]: r[1] for r in flat.select("geoid", spatial.is_valid(F.col("rings"))).collect()} == {"flat": False, "few": False, "good": True}


def test_every_county_has_one_row(spark):
    tiny = [[(5.6, 5.6), (5.7, 5.6), (5.7, 5.7), (5.6, 5.7)]]
    far = [[(50.0, 50.0), (50.1, 50.0), (50.1, 50.1), (50.0, 50.1)]]
    got = {r.geoid: (r.value, r.pixel_count, r.is_nearest) for r in spatial.zonal_mean(shapes(spark, square=SQUARE, tiny=tiny, far=far), grid(spark)).collect()}
    assert got == {"square": (sum(14 * i + j for i in range(4) for j in range(4)) / 16, 16, False), "tiny": (5 * 14 + 5.0, 1, True), "far": (None, 0, False)}


def test_nearest_ties_take_the_lower_axis_and_spacing_is_a_limit(spark):
    points = spark.createDataFrame([("tie", 2.0, 3.0), ("out", -0.1, 3.0)], "geoid string, lon double, lat double")
    assert [(r.geoid, r.near_lat, r.near_lon) for r in spatial.nearest_axes(points, grid(spark)).collect()] == [("tie", 2.5, 1.5)]


def test_box_margin(spark):
    c = shapes(spark, a=[[(1.55, 1.55), (2.4, 1.55), (2.4, 2.4), (1.55, 2.4)]]).withColumn("bbox", spatial.bbox(F.col("rings")))
    assert spatial.cells_in_boxes(c, grid(spark), 0.1).count() == 4
    assert spatial.cells_in_boxes(c, grid(spark), 0.0).count() == 0


def test_regions_of_counties(spark):
    df = spark.createDataFrame([("02001",), ("15001",), ("72001",), ("66010",), ("01001",), ("01001",)], "geoid string")
    assert spatial.counties_of_region(df, "CONUS").count() == 1
    assert {r.geoid for r in spatial.counties_of_region(df, "AK", "HI").collect()} == {"02001", "15001"}
    assert {r[0] for r in df.select(expr.region_of_state(expr.state_of(F.col("geoid")))).collect()} == {"AK", "HI", "PRVI", "GU", "CONUS"}
    with pytest.raises(KeyError):
        region("MARS")
    assert all(is_valid(r) for r in REGIONS.values())


def test_geojson_round_trip(spark, tmp_path):
    out = [r.value for r in spatial.to_geojson(shapes(spark, **{"01001": SQUARE}).withColumn("name", F.lit("A"))).collect()]
    p = tmp_path / "c.json"
    p.write_text('{"type":"FeatureCollection","features":[' + ",".join(out) + "]}")
    back = spatial.from_geojson(spark.read.option("multiLine", True).json(str(p)))
    assert one(back).geoid == "01001" and len(one(back).rings[0]) == 4


def series(spark, values, first=2000, column="mean_temp_c"):
    base = dict(min_temp_c=-5.0, max_temp_c=30.0, annual_precip_mm=1000.0, precip_gt_50mm=20.0, precip_gt_100mm=5.0, mean_temp_c=10.0)
    return county(spark, [("01001", first + i, "historical", *[(base | {column: v})[c] for c in ("mean_temp_c", "min_temp_c", "max_temp_c", "annual_precip_mm", "precip_gt_50mm", "precip_gt_100mm")], 1) for i, v in enumerate(values)])


@pytest.mark.parametrize("rows,found", [(19, 0), (20, 1)])
def test_monotonic_needs_twenty_rows(spark, rows, found):
    assert quality.monotonic(series(spark, [float(i) for i in range(rows)])).count() == found


def test_a_null_or_a_tie_breaks_monotony(spark):
    rising = [float(i) for i in range(25)]
    assert quality.monotonic(series(spark, [*rising[:10], None, *rising[11:]])).count() == 0
    assert quality.monotonic(series(spark, [*rising[:10], rising[9], *rising[11:]])).count() == 0
    assert one(quality.monotonic(series(spark, rising[::-1]))).direction == "falling"


@pytest.mark.parametrize("jump,found", [(5.0, 0), (5.01, 1)])
def test_yearly_change_limit_is_strict(spark, jump, found):
    assert quality.year_over_year(series(spark, [10.0, 10.0 + jump])).count() == found


@pytest.mark.parametrize("excess,count", [(0.1, 0), (0.11, 1)])
def test_temperature_tolerance(spark, excess, count):
    df = county(spark, [("01001", 2000, "historical", 0.0, excess, 30.0, 1.0, 1.0, 1.0, 1)])
    assert one(quality.temperature_logic(df)).min_over_mean == count


def test_completeness_checks(spark):
    df = series(spark, [1.0, None, 3.0])
    dup = df.union(df.where("year = 2000")).union(df.where("year = 2000"))
    assert one(quality.duplicates(dup)).duplicates == 2
    assert {r.column: r.missing for r in quality.missing_percent(df, ["mean_temp_c", "geoid"]).collect()} == {"mean_temp_c": 1, "geoid": 0}
    assert one(quality.incomplete_series(df)).missing_years == 118
    assert one(quality.missing_scenarios(df)).missing == ["ssp245", "ssp585"]
    assert one(quality.county_count(df)).too_few
    assert {(r.metric, r.below, r.above) for r in quality.implausible(series(spark, [50.0, 50.1, -40.0])).collect() if r.metric == "mean_temp_c"} == {("mean_temp_c", 0, 1)}


def test_empty_table(spark):
    empty = county(spark, [])
    assert one(quality.duplicates(empty)).duplicates == 0
    assert one(quality.temperature_logic(empty)).min_over_mean == 0
    assert one(quality.score(quality.issues(empty).where("severity = 'CRITICAL'"))).quality == "EXCELLENT"
    assert outliers.all_methods(quality.long_form(empty)).count() == 0


def test_issues_and_score(spark):
    bad = series(spark, [10.0, 99.0])
    found = quality.issues(bad)
    s = one(quality.score(found))
    assert s.quality == "POOR" and not s.passed and s.critical >= 1
    assert found.columns == ["validator", "severity", "category", "message", "details"]
    assert {r.severity for r in quality.counts_by_severity(found).collect()} >= {"CRITICAL", "WARNING"}


def test_precipitation_rules(spark):
    rows = [("01001", 2000, "historical", 1.0, 0.0, 2.0, 2500.0, 9.0, 1.0, 1), ("01001", 2001, "historical", 1.0, 0.0, 2.0, 400.0, 21.0, 1.0, 1), ("02001", 2000, "ssp245", 1.0, 0.0, 2.0, 1500.0, 10.0, 11.0, 1), ("02001", 2001, "ssp245", 1.0, 0.0, 2.0, None, 0.0, 0.0, 1)]
    df = county(spark, rows)
    r = one(quality.precipitation_patterns(df))
    assert (r.wet_few_days, r.dry_many_days, r.odd_day_mean, r.more_100_than_50) == (1, 1, 1, 1)
    assert {x.scenario: x.problems for x in quality.problems_by(df, "scenario").collect()} == {"historical": 2, "ssp245": 1}
    assert [(x.state, x.problems) for x in quality.problem_states(df).collect()] == [("01", 2), ("02", 1)]
    p = one(quality.problem_profile(df))
    assert (p.least, p.greatest, p.peak_year, p.years, p.slope, p.largest_jump, p.sudden_year) == (1, 2, 2000, 2, None, 1, None)
    assert one(quality.precipitation_issues(df.drop("precip_gt_50mm"))).category == "Missing Columns"


def test_outliers(spark):
    rows = [("0%04d" % c, y, "historical", "m", 10.0 + (c % 3) + (100.0 if c == 7 and y < 2006 else 0.0)) for c in range(20) for y in range(2000, 2010)]
    long = spark.createDataFrame(rows, "geoid string, year int, scenario string, metric string, value double")
    assert [(r.geoid, r.hits) for r in outliers.iqr(long).collect()] == [("00007", 6)]
    assert [(r.geoid, r.hits) for r in outliers.zscore(long).collect()] == [("00007", 6)]
    assert [(r.geoid, r.hits) for r in outliers.modified_zscore(long).collect()] == [("00007", 6)]
    every = outliers.all_methods(long)
    assert [(r.geoid, r.detections) for r in outliers.persistent(every).collect()] == [("00007", 3)]
    assert one(outliers.by_state(outliers.persistent(every))).state == "00"
    assert one(outliers.top_counties(long)).geoid == "00007"


def test_outlier_limits_are_strict(spark):
    rows = [("0%04d" % c, y, "historical", "m", 10.0 + (c % 3) + (100.0 if c == 7 and y < 2005 else 0.0)) for c in range(20) for y in range(2000, 2010)]
    long = spark.createDataFrame(rows, "geoid string, year int, scenario string, metric string, value double")
    assert outliers.zscore(long).count() == 0
    one_year = long.where("year <> 2004 or geoid <> '00007'").where("year > 2003 or geoid <> '00007' or year = 2000")
    assert outliers.iqr(one_year.where("not (geoid = '00007' and year < 2004)")).count() == 0


def test_constant_series_has_no_outliers(spark):
    rows = [(str(c), y, "historical", "m", 5.0 if c else 6.0) for c in range(30) for y in range(2000, 2010)]
    long = spark.createDataFrame(rows, "geoid string, year int, scenario string, metric string, value double")
    assert outliers.modified_zscore(long).count() == 0


def test_summaries(spark):
    df = series(spark, [1.0, 2.0, None, 4.0])
    assert [(r.bin, r.n) for r in summary.histogram(df, "mean_temp_c", 3).orderBy("bin").collect()] == [(0, 1), (1, 1), (2, 1)]
    assert [(r.bin, r.n) for r in summary.histogram(series(spark, [2.0, 2.0]), "mean_temp_c").collect()] == [(0, 2)]
    r = one(summary.trend(df.where("mean_temp_c is not null"), "mean_temp_c"))
    assert r.slope == pytest.approx(1.0)
    assert one(summary.completeness(df, ("mean_temp_c", "annual_precip_mm"))).completeness == pytest.approx(87.5)
    change = one(summary.scenario_change(df, "mean_temp_c", "ssp245", (2001, 2003), (2000, 2000)))
    assert (change.historical, change.future, change.change) == (1.0, None, None)
    d = one(summary.describe(series(spark, [3.0]), "mean_temp_c"))
    assert (d.n, d["std"], d["median"]) == (1, None, 3.0)


def test_task_status(spark):
    t = spark.createDataFrame([("means", "AK", "tas", "completed"), ("means", "HI", "pr", "failed")], "stage string, region string, variable string, status string")
    got = {(r.dimension, r.key): (r.total, r.completed, r.rate) for r in summary.task_status(t).collect()}
    assert got[("overall", "all")] == (2, 1, 50.0) and got[("region", "AK")] == (1, 1, 100.0) and len(got) == 6


def test_contract_rules(spark):
    schema = "id string, variable string, region string, scenario string, target_year int, status string, spatial_bounds struct<min_lon:double,max_lon:double,min_lat:double,max_lat:double>, quality_metrics struct<quality_score:double,completeness_ratio:double,quality_flags:array<string>>, processing_metadata struct<window_start:int,window_end:int,source_files:array<string>>, data_access struct<file_path:string>"
    good = ("tas_CONUS_historical_1995", "tas", "CONUS", "historical", 1995, "completed", (-125.0, -66.5, 25.0, 49.0), (0.98, 0.99, []), (1966, 1995, ["a"]), ("tas/x.nc",))
    bad = ("tas_CONUS_historical_1996", "tas", "CONUS", "historical", 1995, "odd", (-125.0, -66.5, 55.0, 49.0), (1.2, 0.99, ["f"]), (1960, 1990, []), ("../x.nc",))
    rows = contracts.broken_rules(spark.createDataFrame([good, bad], schema)).collect()
    assert rows[0].valid and rows[0].errors == [] and rows[0].warnings == []
    assert set(rows[1].errors) == {"id", "status", "target_year", "bounds", "quality_score", "file_path"}
    assert set(rows[1].warnings) == {"window", "flags", "sources"}


def test_adding_a_null_cell_or_turning_longitudes_changes_nothing(spark):
    c = shapes(spark, square=SQUARE)
    g = grid(spark)
    more = g.union(spark.createDataFrame([(2.25, 2.25, None)], "lat double, lon double, value double"))
    assert one(spatial.zonal_mean(c, g)) == one(spatial.zonal_mean(c, more))
    turned = g.withColumn("lon", expr.lon_180(F.col("lon") + 360))
    assert one(spatial.zonal_mean(c, g)) == one(spatial.zonal_mean(c, turned))
