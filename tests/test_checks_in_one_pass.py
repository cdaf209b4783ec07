"""The issues of one scan against the checks one by one; quantiles in few passes; normals of long windows against plain means."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import county

from stratus.operators import climatology, metrics, quality
from stratus.sources import sinks


def separate(df, t):
    """(severity, message) and the numbers of each finding, from the separate checks."""
    out = {}
    for r in quality.missing_percent(df).collect():
        if r.percent > t.missing_percent:
            out["WARNING", f"{r.column} lacks values"] = {"percent": str(round(r.percent, 2))}
    n = quality.duplicates(df).first().duplicates
    out |= {("CRITICAL", "duplicate county, year and scenario"): {"count": str(n)}} if n else {}
    n = quality.incomplete_series(df, t).count()
    out |= {("WARNING", "series lack years"): {"count": str(n)}} if n else {}
    n = quality.missing_scenarios(df, t).count()
    out |= {("WARNING", "counties lack scenarios"): {"count": str(n)}} if n else {}
    r = quality.county_count(df, t).first()
    out |= {("WARNING", "too few counties"): {"counties": str(r.counties), "expected": str(r.expected)}} if r.too_few else {}
    for r in quality.year_over_year(df, t).groupBy("metric").count().collect():
        out["WARNING", f"extreme yearly changes of {r.metric}"] = {"series": str(r["count"])}
    for r in quality.monotonic(df, t).groupBy("metric").count().collect():
        out["INFO", f"monotonic series of {r.metric}"] = {"series": str(r["count"])}
    for k, n in quality.temperature_logic(df, t).first().asDict().items():
        out |= {("CRITICAL", k): {"count": str(n)}} if n else {}
    n = quality.day_counts(df).first().impossible_days
    out |= {("CRITICAL", "more days than a year has"): {"count": str(n)}} if n else {}
    for r in quality.implausible(df, t).collect():
        out |= {("CRITICAL", f"{r.metric} outside its range"): {"below": str(r.below), "above": str(r.above)}} if r.below + r.above else {}
    return out


@pytest.mark.parametrize("seed", range(4))
def test_issues_are_those_of_the_separate_checks(spark, seed):
    r = random.Random(seed)
    value = lambda a, b: None if r.random() < (0.2 if seed == 1 else 0.02) else r.uniform(a, b)
    rows = []
    for c in range(12):
        for s in ("historical", "ssp245", "ssp585")[: 3 - (c % 4 == 0)]:
            for y in range(2000, 2030 - (c % 3) * (seed > 1)):
                warm = y - 2000.0 if c == 5 else r.uniform(8, 8 + 4 * (seed % 3))
                rows.append((f"0{c:04d}", y, s, value(warm, warm), value(0, 12), value(9, 30 + 40 * (seed == 2)), value(100, 900), value(0, 400 if seed == 3 else 50), value(0, 20), 1))
    df = county(spark, rows)
    df = df.union(df.where("year = 2003 and geoid = '00001'")) if seed % 2 else df
    t = quality.DEFAULT.with_limits(years=(2000, 2029), expected_counties=12 + 5 * (seed > 0))
    found = quality.issues(df, t)
    assert {(x.severity, x.message): x.details for x in found.collect()} == separate(df, t)
    assert found.columns == ["validator", "severity", "category", "message", "details"]


def test_issues_of_an_empty_table(spark):
    empty = county(spark, [])
    assert {(x.severity, x.message): x.details for x in quality.issues(empty).collect()} == separate(empty, quality.DEFAULT)


def test_issues_scan_once(spark, tmp_path):
    county(spark, [("01001", 2000, "historical", 1.0, 0.0, 2.0, 3.0, 4.0, 5.0, 1)]).write.parquet(str(tmp_path / "t"))
    plan = quality.issues(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


@pytest.mark.parametrize("rows", [30, 7])
@pytest.mark.parametrize("spread", [3, 50, 100_000])
def test_quantiles_with_ties_and_narrow_bands(spark, monkeypatch, rows, spread):
    monkeypatch.setattr(metrics, "BAND_ROWS", rows)
    monkeypatch.setattr(metrics, "SKETCH_ERROR", 0.01)
    r = np.random.default_rng(spread)
    values = np.where(r.random(4000) < 0.3, 7.0, np.round(r.exponential(spread, 4000), 2))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    wanted = [0.0, 0.001, 0.05, 0.299, 0.3, 0.5, 0.77, 0.95, 0.999, 1.0]
    got = metrics.exact_quantiles(df, {str(q): ("v", q) for q in wanted})
    assert [got[str(q)] for q in wanted] == pytest.approx([float(np.quantile(values, q)) for q in wanted])


@pytest.mark.parametrize("window, least", [(30, 25), (5, 3), (1, 1)])
def test_normals_against_plain_means(spark, window, least):
    """Years with gaps, cells that lack years, and readings without a value."""
    r = random.Random(window)
    years = [y for y in range(1950, 2021) if y not in (1961, 1990, 1991)]
    rows = [(v, y, d, float(la), 2.0, None if r.random() < 0.1 else r.uniform(-30, 40)) for v in ("tas", "pr") for y in years for d in (1, 2) for la in (0, 1) if r.random() < 0.8]
    daily = climatology.with_cell(spark.createDataFrame(rows, "variable string, year int, doy int, lat double, lon double, value double"))
    got = {(x.variable, x.target_year, x.doy, x.lat): x for x in climatology.climate_normal(daily, window, least, ("variable",)).collect()}
    want = {}
    for v in ("tas", "pr"):
        present = sorted({x[1] for x in rows if x[0] == v})
        for t in range(1950, 2021 + window):
            held = [y for y in present if t - window < y <= t]
            if len(held) < least:
                continue
            for d in (1, 2):
                for la in (0.0, 1.0):
                    own = [x[5] for x in rows if x[0] == v and x[2] == d and x[3] == la and t - window < x[1] <= t]
                    if own:
                        values = [z for z in own if z is not None]
                        want[v, t, d, la] = (sum(values) / len(values) if values else None, len(held), held[0], held[-1])
    assert got.keys() == want.keys()
    for k, (value, n, first, last) in want.items():
        assert (got[k].num_years, got[k].source_start, got[k].source_end) == (n, first, last)
        assert got[k].value == (pytest.approx(value, abs=1e-9) if value is not None else None)


def test_planned_normals_against_plain_means(spark):
    r = random.Random(2)
    rows = [("tas", s, y, 1, 1.0, 2.0, r.uniform(0, 9)) for s, ys in (("historical", range(1980, 2015)), ("ssp245", range(2015, 2060)), ("ssp585", range(2010, 2060))) for y in ys if r.random() < 0.95]
    daily = climatology.with_cell(spark.createDataFrame(rows, "variable string, scenario string, year int, doy int, lat double, lon double, value double"))
    plan = climatology.period_plan(spark).where("target_year < 2062")
    got = {(x.scenario, x.period_type, x.target_year): (x.value, x.num_years) for x in climatology.normals_from_plan(daily, plan, 25).collect()}
    want = {}
    for p in plan.collect():
        own = [x[6] for x in rows if p.start_year <= x[2] <= p.end_year and x[1] == ("historical" if p.period_type == "historical" or (p.period_type == "hybrid" and x[2] <= 2014) else p.scenario)]
        if len(own) >= 25:
            want[p.scenario, p.period_type, p.target_year] = (pytest.approx(sum(own) / len(own), abs=1e-9), len(own))
    assert got == want and len(want) > 50


def test_a_report_tells_what_it_leaves_out(spark):
    found = spark.range(7).select(F.lit("qaqc").alias("validator"), F.lit("WARNING").alias("severity"), F.lit("c").alias("category"), F.concat(F.lit("m"), F.col("id")).alias("message"), F.create_map().cast("map<string,string>").alias("details"))
    rows = sinks.report_rows(found, 5)
    assert len(rows) == 6 and rows[-1]["message"].startswith("2 more issues") and len(sinks.report_rows(found, 7)) == 7
    assert "2 more issues" in sinks.render_markdown(rows)
