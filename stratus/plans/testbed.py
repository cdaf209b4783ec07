"""The climate shapes that the queries start from, mapped from the star-schema tables.

A supplier is a grid cell and a county of its own, its nation a larger county, a line item a daily reading, an order a task and file,
a part a cell of a square grid that grows with the table. Every table is mapped whole. The same mapping is written once for Spark and once for the SQL that queries are held against.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """geoid (nation), county (supplier), state, region, cell_id, lon 0..360, lat, scenario, year, doy, tas, tasmax, tasmin in K, pr as a flux."""
    cells = (
        read(spark, sf_dir, "supplier")
        .join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("geoid"),
            F.lpad((F.col("n_nationkey") * 1000 + F.col("s_suppkey") % 1000).cast("string"), 5, "0").alias("county"),
            F.col("r_name").alias("region"),
            F.col("s_suppkey").alias("cell_id"),
            (F.col("s_suppkey") * 37 % 360).cast("double").alias("lon"),
            (F.col("s_suppkey") * 53 % 180 - 90).cast("double").alias("lat"),
        )
    )
    y = F.year("l_shipdate")
    readings = read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("cell_id"),
        F.when(y <= 1997, "historical").when(F.col("l_returnflag") == "A", "ssp245").otherwise("ssp585").alias("scenario"),
        y.alias("year"),
        F.dayofyear("l_shipdate").alias("doy"),
        (F.col("l_quantity") + 250).alias("tas"),
        (F.col("l_quantity") + 250 + F.col("l_discount") * 100).alias("tasmax"),
        (F.col("l_quantity") + 250 - F.col("l_tax") * 100).alias("tasmin"),
        (F.col("l_extendedprice") / 1e8).alias("pr"),
    )
    return readings.join(cells, "cell_id")


OBS = """obs as (
  select lpad(cast(n_nationkey as varchar), 5, '0') geoid, lpad(cast(n_nationkey * 1000 + s_suppkey % 1000 as varchar), 5, '0') county,
    r_name region, s_suppkey cell_id, cast(s_suppkey * 37 % 360 as double) lon, cast(s_suppkey * 53 % 180 - 90 as double) lat,
    case when year(l_shipdate) <= 1997 then 'historical' when l_returnflag = 'A' then 'ssp245' else 'ssp585' end scenario,
    year(l_shipdate) "year", dayofyear(l_shipdate) doy, l_quantity + 250 tas, l_quantity + 250 + l_discount * 100 tasmax, l_quantity + 250 - l_tax * 100 tasmin, l_extendedprice / 1e8 pr
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def county_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide validation table; the coldest counties' precipitation of odd years is missing."""
    c, mm = F.col("tas") - 273.15, F.col("pr") * 86400.0
    g = obs(spark, sf_dir).groupBy(F.col("county").alias("geoid"), "year", "scenario").agg(
        F.avg(c).alias("mean_temp_c"), F.min(c).alias("min_temp_c"), F.max(c).alias("max_temp_c"), F.sum(mm).alias("__pr"),
        F.count_if(mm > 50).cast("double").alias("precip_gt_50mm"), F.count_if(mm > 75).cast("double").alias("precip_gt_100mm"), F.count("*").alias("pixel_count"),
    )
    gone = (F.col("geoid").cast("int") % 7 == 0) & (F.col("year") % 2 == 1)
    return g.select("geoid", "year", "scenario", "mean_temp_c", "min_temp_c", "max_temp_c", F.when(~gone, F.col("__pr")).alias("annual_precip_mm"), "precip_gt_50mm", "precip_gt_100mm", "pixel_count")


COUNTY_YEAR = f"""{OBS}, county_year as (
  select * exclude (total), case when not (cast(geoid as int) % 7 = 0 and "year" % 2 = 1) then total end annual_precip_mm from (
    select county geoid, "year", scenario, avg(tas - 273.15) mean_temp_c, min(tas - 273.15) min_temp_c, max(tas - 273.15) max_temp_c, sum(pr * 86400.0) total,
      cast(count_if(pr * 86400.0 > 50) as double) precip_gt_50mm, cast(count_if(pr * 86400.0 > 75) as double) precip_gt_100mm, count(*) pixel_count
    from obs group by all))"""

LONG = f"""{COUNTY_YEAR}, long as (
  select geoid, "year", scenario, unnest(['mean_temp_c', 'min_temp_c', 'max_temp_c', 'annual_precip_mm', 'precip_gt_50mm', 'precip_gt_100mm']) metric,
    unnest([mean_temp_c, min_temp_c, max_temp_c, annual_precip_mm, precip_gt_50mm, precip_gt_100mm]) value from county_year)"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue of files from orders: id, region, variable, scenario, year, quality, status, path, size."""
    y, k = F.year("o_orderdate"), F.col("o_orderkey")
    o = read(spark, sf_dir, "orders")
    variable = F.element_at(F.array(*[F.lit(v) for v in ("pr", "tas", "tasmax", "tasmin")]), (k % 4 + 1).cast("int"))
    region = F.element_at(F.array(*[F.lit(r) for r in ("CONUS", "AK", "HI", "PRVI", "GU")]), (F.col("o_custkey") % 5 + 1).cast("int"))
    scenario = F.when(y <= 1997, "historical").when(k % 3 == 0, "ssp245").otherwise("ssp585")
    return o.select(
        k.alias("id"), region.alias("region"), variable.alias("variable"), scenario.alias("scenario"), y.alias("year"),
        (F.col("o_totalprice") % 1000 / 1000).alias("quality"), F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "failed").otherwise("pending").alias("status"),
        F.col("o_orderpriority").alias("stage"), F.concat(variable, F.lit("/"), scenario, F.lit("/"), variable, F.lit("_day_NorESM2-LM_"), scenario, F.lit("_r1i1p1f1_gn_"), y.cast("string"), F.when(k % 2 == 0, F.lit("_v1.1")).otherwise(F.lit("")), F.lit(".nc")).alias("path"),
        F.floor("o_totalprice").alias("size"), (F.col("o_totalprice") / 1000).alias("seconds"),
    )


FILES = """files as (
  select o_orderkey id, ['CONUS', 'AK', 'HI', 'PRVI', 'GU'][o_custkey % 5 + 1] region, ['pr', 'tas', 'tasmax', 'tasmin'][o_orderkey % 4 + 1] variable,
    case when year(o_orderdate) <= 1997 then 'historical' when o_orderkey % 3 = 0 then 'ssp245' else 'ssp585' end scenario, year(o_orderdate) "year",
    o_totalprice % 1000 / 1000 quality, case o_orderstatus when 'F' then 'completed' when 'P' then 'failed' else 'pending' end status, o_orderpriority stage,
    floor(o_totalprice)::bigint size, o_totalprice / 1000 as seconds, o_orderkey % 2 = 0 has_version,
    variable || '/' || scenario || '/' || variable || '_day_NorESM2-LM_' || scenario || '_r1i1p1f1_gn_' || "year" || case when has_version then '_v1.1' else '' end || '.nc' as path
  from orders)"""


def square(k: Column) -> tuple[Column, Column]:
    """A place (i, j) of its own for each k from 0 on: squares around the origin are filled one after another."""
    side = F.floor(F.sqrt(k.cast("double")))
    rest = k - side * side
    return F.when(rest <= side, side).otherwise(2 * side - rest), F.when(rest <= side, rest).otherwise(side)


def square_sql(k: str) -> str:
    """The same as two columns i and j."""
    side, rest = f"floor(sqrt({k}))::bigint", f"({k} - floor(sqrt({k}))::bigint ** 2)::bigint"
    return f"case when {rest} <= {side} then {side} else 2 * {side} - {rest} end i, case when {rest} <= {side} then {rest} else {side} end j"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lat, lon, value of a square grid of one-degree steps, a cell for each part; every seventh value is missing."""
    i, j = square(F.col("p_partkey"))
    return read(spark, sf_dir, "part").select((i + 0.5).cast("double").alias("lat"), (j + 0.5).cast("double").alias("lon"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_retailprice")).alias("value"))


CELLS = f"""cells as (
  select i + 0.5::double lat, j + 0.5::double lon, value from (select {square_sql("p_partkey")}, case when p_partkey % 7 <> 0 then p_retailprice end value from part))"""


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds of different sizes all over the grid, some too small to hold a cell centre."""
    k = F.col("s_suppkey")
    i, j = square(k)
    s = read(spark, sf_dir, "supplier")
    x, y, r = i * 4 + F.lit(2.1), j * 4 + F.lit(1.13), (k % 5 * 0.75 + 0.2).cast("double")
    ring = F.array(*[F.struct((x + a * r).alias("lon"), (y + b * r).alias("lat")) for a, b in ((-1, 0), (0, -1), (1, 0), (0, 1))])
    return s.select(F.lpad(k.cast("string"), 5, "0").alias("geoid"), F.col("s_name").alias("name"), F.array(ring).alias("rings"), x.alias("x"), y.alias("y"), r.alias("r"))


COUNTIES = f"""counties as (
  select lpad(cast(s_suppkey as varchar), 5, '0') geoid, i * 4 + 2.1::double x, j * 4 + 1.13::double y, s_suppkey % 5 * 0.75 + 0.2 r
  from (select s_suppkey, {square_sql("s_suppkey")} from supplier))"""
