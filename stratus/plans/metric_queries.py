"""Queries of the indicator operators: cell reductions, county means, box statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.operators import metrics
from stratus.plans.registry import query
from stratus.plans.testbed import OBS, obs

KEYS = ("geoid", "year", "scenario", "region")
UNIT = f"""{OBS}, u as (select geoid, "year", scenario, region, cell_id, tas - 273.15 t, tasmax - 273.15 x, tasmin - 273.15 n, pr * 86400.0 p from obs)"""
LONG = "geoid:s year:i scenario:s value:d pixel_count:i"
COUNTED = "geoid:s year:i scenario:s value:d threshold:d pixel_count:i"


def _units(spark, sf_dir):
    return metrics.in_metric_units(obs(spark, sf_dir))


def _county(spark, sf_dir, *names):
    cells = metrics.cell_metrics(_units(spark, sf_dir), list(names), (*KEYS, "cell_id"))
    return metrics.county_metrics(cells, list(names), KEYS)


def _sql(reduction: str) -> str:
    return f'select geoid, "year", scenario, avg(c) value, count(c) pixel_count from (select geoid, "year", scenario, region, cell_id, {reduction} c from u group by all) group by all'


def _days(column: str, q: float, sign: str) -> str:
    return f'select geoid, "year", scenario, avg(c) value, max(th) threshold, count(c) pixel_count from (select geoid, "year", scenario, region, cell_id, sum(cast({column} {sign} th as bigint)) c, max(th) th from u, (select quantile_cont({column}, {q}) th from u) group by all) group by all'


@query(LONG, _sql("avg(t)"), UNIT)
def annual_mean_temp(spark, sf_dir):
    """A4."""
    return _county(spark, sf_dir, "mean_temp_c")


@query(LONG, _sql("sum(greatest(t - 10, 0))"), UNIT)
def growing_degree_days(spark, sf_dir):
    """A5."""
    return _county(spark, sf_dir, "growing_degree_days")


@query(LONG, _sql("min(n)"), UNIT)
def annual_min_temp(spark, sf_dir):
    """A6."""
    return _county(spark, sf_dir, "min_temp_c")


@query(LONG, _sql("max(x)"), UNIT)
def annual_max_temp(spark, sf_dir):
    """A7."""
    return _county(spark, sf_dir, "max_temp_c")


@query("geoid:s year:i scenario:s precip_mean:d precip_min:d precip_max:d pixel_count:i", 'select geoid, "year", scenario, avg(c) precip_mean, min(c) precip_min, max(c) precip_max, count(c) pixel_count from (select geoid, "year", scenario, cell_id, sum(p) c from u group by all) group by all', UNIT)
def annual_precip(spark, sf_dir):
    """Mean, least and greatest of the cells' sums."""
    cells = metrics.cell_metrics(_units(spark, sf_dir), ["annual_precip_mm"], (*KEYS, "cell_id"))
    return metrics.precipitation_spread(cells, KEYS)


@query(COUNTED, _days("x", 0.90, ">"), UNIT)
def hot_days_p90(spark, sf_dir):
    """A9."""
    return _county(spark, sf_dir, "high_temp_days_p90")


@query(COUNTED, _days("x", 0.95, ">"), UNIT)
def hot_days_p95(spark, sf_dir):
    """A10."""
    return _county(spark, sf_dir, "high_temp_days_p95")


@query(COUNTED, _days("n", 0.10, "<"), UNIT)
def cold_days_p10(spark, sf_dir):
    """A11."""
    return _county(spark, sf_dir, "low_temp_days_p10")


@query(COUNTED, _days("n", 0.05, "<"), UNIT)
def cold_days_p5(spark, sf_dir):
    """A12."""
    return _county(spark, sf_dir, "low_temp_days_p5")


@query(COUNTED, _days("n", 0.01, "<"), UNIT)
def cold_days_p1(spark, sf_dir):
    """A13."""
    return _county(spark, sf_dir, "low_temp_days_p1")


@query(COUNTED, _days("p", 0.95, ">"), UNIT)
def wet_days_p95(spark, sf_dir):
    """A14."""
    return _county(spark, sf_dir, "wet_days_p95")


WIDE = "geoid:s year:i scenario:s mean_temp_c_value:d high_temp_days_p90_value:d high_temp_days_p90_threshold:d wet_days_p95_value:d annual_precip_mm_value:d mean_temp_c_pixel_count:i"


@query(
    WIDE,
    """select geoid, "year", scenario, avg(a) mean_temp_c_value, avg(h) high_temp_days_p90_value, max(ht) high_temp_days_p90_threshold, avg(w) wet_days_p95_value, avg(s) annual_precip_mm_value, count(a) mean_temp_c_pixel_count from
      (select geoid, "year", scenario, cell_id, avg(t) a, sum(cast(x > ht as bigint)) h, max(ht) ht, sum(cast(p > wt as bigint)) w, sum(p) s from u, (select quantile_cont(x, 0.9) ht, quantile_cont(p, 0.95) wt from u) group by all) group by all""",
    UNIT,
)
def metrics_wide(spark, sf_dir):
    """Several metrics of a county in one row, computed in one pass."""
    names = ["mean_temp_c", "high_temp_days_p90", "wet_days_p95", "annual_precip_mm"]
    return metrics.wide(_county(spark, sf_dir, *names), names, KEYS)


EVERY = {
    "mean_temp_c": ("avg(t)", None), "growing_degree_days": ("sum(greatest(t - 10, 0))", None), "min_temp_c": ("min(n)", None), "max_temp_c": ("max(x)", None), "annual_precip_mm": ("sum(p)", None),
    "high_temp_days_p90": ("sum(cast(x > x90 as bigint))", "x90"), "high_temp_days_p95": ("sum(cast(x > x95 as bigint))", "x95"), "low_temp_days_p10": ("sum(cast(n < n10 as bigint))", "n10"),
    "low_temp_days_p5": ("sum(cast(n < n05 as bigint))", "n05"), "low_temp_days_p1": ("sum(cast(n < n01 as bigint))", "n01"), "wet_days_p95": ("sum(cast(p > p95 as bigint))", "p95"),
}


@query(
    "geoid:s year:i scenario:s variable:s metric:s value:d threshold:d pixel_count:i",
    f"""select geoid, "year", scenario, unnest([{", ".join(f"'{metrics.METRICS[k].variable}'" for k in EVERY)}]) "variable", unnest([{", ".join(f"'{k}'" for k in EVERY)}]) metric,
      unnest([{", ".join(f"avg(c_{k})" for k in EVERY)}]) "value", unnest([{", ".join(f"max({t})" if t else "null" for _, t in EVERY.values())}]) threshold, unnest([{", ".join(f"count(c_{k})" for k in EVERY)}]) pixel_count
      from (select geoid, "year", scenario, region, cell_id, {", ".join(f"{e} c_{k}" for k, (e, _) in EVERY.items())}, {", ".join(f"max({t}) {t}" for _, t in EVERY.values() if t)} from u,
        (select quantile_cont(x, 0.9) x90, quantile_cont(x, 0.95) x95, quantile_cont(n, 0.1) n10, quantile_cont(n, 0.05) n05, quantile_cont(n, 0.01) n01, quantile_cont(p, 0.95) p95 from u) group by geoid, "year", scenario, region, cell_id)
      group by geoid, "year", scenario, region""",
    UNIT,
)
def all_metrics(spark, sf_dir):
    """Every registered metric in one aggregation by cell and one by county."""
    return _county(spark, sf_dir, *metrics.METRICS)


BOX = "geoid:s year:i num_grid_points:i mean:d std:d min:d max:d"


@query(BOX, 'select geoid, "year", count(t) num_grid_points, avg(t) mean, stddev_pop(t) std, min(t) min, max(t) max from u group by all', UNIT)
def box_stats(spark, sf_dir):
    """Count, mean, population deviation and extremes."""
    return metrics.box_statistics(_units(spark, sf_dir), "tas", ("geoid", "year"))


@query("geoid:s year:i p5:d p50:d p95:d", 'select geoid, "year", quantile_cont(t, 0.05) p5, quantile_cont(t, 0.5) p50, quantile_cont(t, 0.95) p95 from u group by all', UNIT)
def box_percentiles(spark, sf_dir):
    """Exact percentiles."""
    return metrics.box_statistics(_units(spark, sf_dir), "tas", ("geoid", "year"), (5, 50, 95))


@query("q:d value:d", "select unnest([0.01, 0.5, 0.9]) q, unnest(quantile_cont(p, [0.01, 0.5, 0.9])) value from u", UNIT)
def exact_quantiles(spark, sf_dir):
    """Exact global quantiles in a few passes, for tables too large to keep every value."""
    found = metrics.exact_quantiles(_units(spark, sf_dir), {str(q): ("pr", q) for q in (0.01, 0.5, 0.9)})
    return spark.createDataFrame([(float(q), v) for q, v in found.items()], "q double, value double")


@query("tas:d converted:d", "select 250 + x tas, 250 + x - 273.15 converted from (select distinct l_quantity x from lineitem)")
def kelvin_if_large(spark, sf_dir):
    """A column whose greatest value is over 100 is in Kelvin."""
    from stratus.functions import expr

    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select((F.col("l_quantity") + 250).alias("tas")).distinct()
    return expr.celsius_if_kelvin(t.withColumn("converted", F.col("tas")), "converted")
