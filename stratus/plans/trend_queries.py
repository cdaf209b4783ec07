"""Queries of model calendars, trends, spells, neighbours and droughts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus.functions import calendars
from stratus.operators import neighbours, quality, spells, trends
from stratus.plans.registry import query
from stratus.plans.testbed import CELLS, COUNTY_YEAR, LONG, OBS, cells, county_year, obs, read

# Each order's key is an offset in one of four calendars.
_OFFSETS = "select o_orderkey as id, ['noleap', '360_day', 'standard', '366_day'][o_orderkey % 4 + 1] as calendar, o_orderkey // 4 % 60000 + 0.25 as days from orders"
_MONTHS = "[0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334]"


# fmt: off
@query("id:i year:i month:i day:i doy:i hours:d back:d", f"""with offsets as ({_OFFSETS}), whole as (select *, floor(days)::bigint as d from offsets),
    parts as (select *, case calendar when 'noleap' then 1850 + d // 365 when '366_day' then 1850 + d // 366 when '360_day' then 1850 + d // 360 else year(date '1850-01-01' + d::int) end as y,
      case calendar when 'noleap' then d % 365 + 1 when '366_day' then d % 366 + 1 when '360_day' then d % 360 + 1 else dayofyear(date '1850-01-01' + d::int) end as n from whole),
    placed as (select *, case calendar when '360_day' then (n - 1) // 30 + 1 when 'standard' then month(date '1850-01-01' + d::int) when 'noleap' then len(list_filter({_MONTHS}, lambda b: b < n))
      else len(list_filter(list_transform({_MONTHS}, lambda b, i: b + case when i > 2 then 1 else 0 end), lambda b: b < n)) end as m from parts)
    select id, y as "year", m as "month", case calendar when '360_day' then (n - 1) % 30 + 1 when 'standard' then day(date '1850-01-01' + d::int) when 'noleap' then n - {_MONTHS}[m] else n - {_MONTHS}[m] - case when m > 2 then 1 else 0 end end as "day", n as doy, 6.0 as hours, d as back from placed""")
# fmt: on
def model_dates(spark, sf_dir):
    """Dates of offsets, and the offsets of those dates."""
    k = F.col("o_orderkey")
    calendar = F.element_at(F.array(*map(F.lit, ("noleap", "360_day", "standard", "366_day"))), (k % 4 + 1).cast("int"))
    hours = (F.floor(k / 4) % 60000 + 0.25) * 24 - 12
    units = F.lit("hours since 1850-01-01 12:00:00")
    rows = read(spark, sf_dir, "orders").select(k.alias("id"), calendar.alias("calendar"), calendars.decoded_time(hours, units, calendar).alias("t"))
    back = calendars.encoded_time(F.col("t.year"), F.col("t.month"), F.col("t.day"), F.lit("days since 1850-01-01"), F.col("calendar"))
    return rows.select("id", "t.*", back.alias("back"))


# fmt: off
@query("geoid:s scenario:s metric:s n:i s:i variance:d z:d slope:d trend:s", f"""with {LONG}, series as (select geoid, scenario, metric, "year" as y, value from long where value is not null),
    pairs as (select a.geoid, a.scenario, a.metric, sum(sign(b.value - a.value)) as s, median((b.value - a.value) / (b.y - a.y)) as slope from series a join series b on a.geoid = b.geoid and a.scenario = b.scenario and a.metric = b.metric and a.y < b.y group by all),
    held as (select geoid, scenario, metric, sum(t) as n, (sum(t) * (sum(t) - 1) * (2 * sum(t) + 5) - sum(t * (t - 1) * (2 * t + 5))) / 18 as variance from (select geoid, scenario, metric, value, count(*) as t from series group by all) group by all),
    tested as (select held.*, coalesce(s, 0) as s, slope, case when variance > 0 then (coalesce(s, 0) - sign(coalesce(s, 0))) / sqrt(variance) else 0 end as z from held left join pairs using (geoid, scenario, metric))
    select geoid, scenario, metric, n, s, variance, z, slope, case when abs(z) <= 1.959963984540054 then 'no_trend' when s > 0 then 'increasing' else 'decreasing' end as trend from tested""")
# fmt: on
def mann_kendall_trends(spark, sf_dir):
    """§2.14: Mann-Kendall and Sen's slope of every county, scenario and metric."""
    df = county_year(spark, sf_dir)
    long = quality.long_form(df, ["mean_temp_c", "min_temp_c", "max_temp_c", "annual_precip_mm", "precip_gt_50mm", "precip_gt_100mm"])
    return trends.mann_kendall(long, "value", ("geoid", "scenario", "metric"))


@query("geoid:s segment:i first_year:i last_year:i n:i mean:d shift:d severity:s")
def change_points_of_counties(spark, sf_dir):
    """§2.14: segments of every county's yearly mean temperatures (no SQL: a dynamic programme)."""
    return trends.change_points(county_year(spark, sf_dir), "mean_temp_c", ("geoid",), least=2)


# fmt: off
@query("geoid:s years:i first:d last:d", 'select geoid, count(*) as years, arg_min(v, "year") as "first", arg_max(v, "year") as "last" from (select geoid, "year", avg(mean_temp_c) as v from county_year where mean_temp_c is not null group by all) group by all', COUNTY_YEAR)
# fmt: on
def yearly_series(spark, sf_dir):
    """The series that trends are taken of."""
    s = trends.series_of(county_year(spark, sf_dir), "mean_temp_c", ("geoid",))
    return s.select("geoid", F.size("years").alias("n"), F.get("values", F.lit(0)).alias("first"), F.element_at("values", -1).alias("last")).withColumnRenamed("n", "years")


_SPELLS = """with flagged as (select distinct county, scenario, "year" * 365 + least(doy, 365) - 1 as d from obs where {}),
    runs as (select county, scenario, min(d) as a, count(*) as n from (select *, d - row_number() over (partition by county, scenario order by d) as r from flagged) group by county, scenario, r having count(*) >= {})
    select county as geoid, scenario, a // 365 as "year", count(*) as events, sum(n) as days, max(n) as longest from runs group by all"""


def yearly_spells(rows, flag, at_least):
    found = spells.spells(rows.withColumn("geoid", F.col("county")), flag, ("geoid", "scenario"), at_least=at_least)
    return spells.spells_by_year(found, ("geoid", "scenario"))


@query("geoid:s scenario:s year:i events:i days:i longest:i", _SPELLS.format("tasmax - 273.15 > 10", 3), OBS)
def heat_waves(spark, sf_dir):
    """§2.14: runs of three hot days and more, also across the turn of the year."""
    return yearly_spells(obs(spark, sf_dir), spells.hot(F.col("tasmax"), 10.0), 3)


@query("geoid:s scenario:s year:i events:i days:i longest:i", _SPELLS.format("tasmin - 273.15 < 0", 2), OBS)
def cold_snaps(spark, sf_dir):
    """§2.14: runs of two frost days and more."""
    return yearly_spells(obs(spark, sf_dir), spells.cold(F.col("tasmin")), 2)


@query("geoid:s scenario:s year:i events:i days:i longest:i", _SPELLS.format("pr * 86400 < 30", 1), OBS)
def dry_spells(spark, sf_dir):
    """§2.14: runs of dry days, the longest of each year among them."""
    return yearly_spells(obs(spark, sf_dir), spells.dry(F.col("pr"), 30.0), 1)


def rainfall(spark, sf_dir):
    mm = F.col("pr") * 86400.0
    rows = obs(spark, sf_dir).withColumn("geoid", F.col("county"))
    return spells.monthly_totals(rows, F.when(mm > 20, mm - 20).otherwise(0.0), ("geoid",))


# fmt: off
_MONTHLY = f"""{OBS}, months as (select county as geoid, "year" as y, len(list_filter([0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334], lambda b: b < least(doy, 365))) as m, sum(greatest(pr * 86400.0 - 20, 0)) as total from obs group by all)"""


@query("geoid:s month:i n:i dry:d shape:d scale:d", """with sums as (select geoid, m, count(*) as n, count_if(total > 0) as wet, avg(total) filter (total > 0) as mean, avg(ln(total)) filter (total > 0) as logs from months group by all),
    fits as (select *, case when wet >= 4 and ln(mean) - logs > 1e-12 then (1 + sqrt(1 + 4 * (ln(mean) - logs) / 3)) / (4 * (ln(mean) - logs)) end as shape from sums)
    select geoid, m as "month", n, 1 - wet / n as dry, shape, mean / shape as scale from fits""", _MONTHLY)
# fmt: on
def rainfall_distributions(spark, sf_dir):
    """§2.14: gamma distributions of monthly rain by county and calendar month."""
    return spells.gamma_fits(rainfall(spark, sf_dir), ("geoid",))


# fmt: off
@query("geoid:s year:i month:i total:d", """select a.geoid, a.y as "year", a.m as "month", sum(b.total) as total from months a join months b on a.geoid = b.geoid and b.y * 12 + b.m between a.y * 12 + a.m - 2 and a.y * 12 + a.m
    group by a.geoid, a.y, a.m having count(*) = 3""", _MONTHLY)
# fmt: on
def rainfall_of_three_months(spark, sf_dir):
    """§2.14: what the three-month drought index is taken of."""
    return spells.accumulated(rainfall(spark, sf_dir), ("geoid",), 3)


@query("geoid:s year:i month:i total:d index:d")
def drought_of_three_months(spark, sf_dir):
    """§2.14: the index itself (no SQL: gamma and normal distributions; tests compare it with a plain version)."""
    return spells.drought_index(spells.accumulated(rainfall(spark, sf_dir), ("geoid",), 3), ("geoid",))


def squares(spark, sf_dir):
    """The test bed's cells as counties that share edges."""
    x, y = F.col("lon") - 0.5, F.col("lat") - 0.5
    ring = F.array(*[F.struct((x + a).alias("lon"), (y + b).alias("lat")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))])
    return cells(spark, sf_dir).select(F.format_string("%d:%d", y.cast("int"), x.cast("int")).alias("geoid"), "value", F.array(ring).alias("rings"))


_SQUARES = f"""{CELLS}, squares as (select floor(lat)::int as i, floor(lon)::int as j, floor(lat)::int || ':' || floor(lon)::int as geoid, value from cells)"""


@query("geoid:s neighbours:i", "select a.geoid, count(*) as neighbours from squares a join squares b on abs(a.i - b.i) + abs(a.j - b.j) = 1 group by a.geoid", _SQUARES)
def counties_side_by_side(spark, sf_dir):
    """§2.14: counties that share an edge."""
    return neighbours.contiguity(squares(spark, sf_dir)).groupBy("geoid").agg(F.count("*").alias("neighbours"))


# fmt: off
@query("geoid:s z:d lag:d moran:d neighbours:i quadrant:s", """with scored as (select *, (value - avg(value) over ()) / stddev_pop(value) over () as z from squares where value is not null),
    near as (select a.geoid, avg(b.z) as lag, count(*) as n from scored a join scored b on abs(a.i - b.i) + abs(a.j - b.j) = 1 group by a.geoid)
    select geoid, z, lag, z * lag as moran, coalesce(n, 0) as neighbours, case when lag is null then 'none' else case when z > 0 then 'high' else 'low' end || '-' || case when lag > 0 then 'high' else 'low' end end as quadrant
    from scored left join near using (geoid)""", _SQUARES)
# fmt: on
def local_moran_of_counties(spark, sf_dir):
    """§2.14: local spatial correlation of values among counties that share edges."""
    s = squares(spark, sf_dir)
    return neighbours.local_moran(s, neighbours.contiguity(s))


@query("geoid:s p:d")
def moran_significance(spark, sf_dir):
    """§2.14: pseudo-p of the local statistic by seeded permutations (no SQL: hashes)."""
    s = squares(spark, sf_dir)
    return neighbours.local_moran(s, neighbours.contiguity(s), neighbours.PERMUTATIONS)
