"""File catalogue: which variable, scenario and year a file holds, what is there and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions import expr
from stratus.regions import model, region


def list_files(spark: SparkSession, path: str, name: str = "NorESM2-LM", glob: str = "*.nc") -> DataFrame:
    """path, size, and what the model's file pattern tells: variable, scenario, year, version, ensemble, grid. Empty files are not listed."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", F.col("length").alias("size"))
    return with_metadata(found, name)


def with_metadata(files: DataFrame, name: str = "NorESM2-LM", path: str = "path") -> DataFrame:
    """The parts of each file name as columns; names that don't fit the pattern have only a year, if any."""
    m = expr.metadata_of_name(F.col(path), model(name).pattern)
    parts = files.withColumn("__m", m)
    year = F.coalesce(F.col("__m.year").cast("int"), expr.year_of_name(F.col(path)))
    named = [F.col(f"__m.{k}").alias(k) for k in ("variable", "frequency", "model", "scenario", "ensemble", "grid", "version")]
    return parts.select(*files.columns, *named, year.alias("year"))


def files_for_period(files: DataFrame, variable: str, scenario: str, first: int, last: int) -> DataFrame:
    """Files of a variable and scenario with years in a range, by year; both keys prune partitions."""
    return files.where((F.col("variable") == variable) & (F.col("scenario") == scenario) & F.col("year").between(first, last)).orderBy("year", "path")


def available_years(files: DataFrame, variable: str, scenario: str) -> DataFrame:
    """One row: first and last year, 0 and 0 without any."""
    kept = files.where((F.col("variable") == variable) & (F.col("scenario") == scenario))
    return kept.agg(F.coalesce(F.min("year"), F.lit(0)).alias("first_year"), F.coalesce(F.max("year"), F.lit(0)).alias("last_year"))


def availability(files: DataFrame) -> DataFrame:
    """variable, scenario, first and last year, where years are known."""
    return files.groupBy("variable", "scenario").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year")).where("first_year > 0")


def hybrid_files(files: DataFrame, variable: str, projection: str, first: int, last: int, hist_end: int = 2014) -> DataFrame:
    """Historical files up to the cut year and projected ones after it."""
    historical = (F.col("scenario") == "historical") & (F.col("year") <= hist_end)
    return files.where((F.col("variable") == variable) & F.col("year").between(first, last) & (historical | ((F.col("scenario") == projection) & (F.col("year") > hist_end)))).orderBy("year", "path")


def metric_inputs(files: DataFrame) -> DataFrame:
    """Adds a year from the file name and a scenario from the name, else from the year; by year, unknown ones first."""
    year = F.coalesce(F.col("year"), expr.year_of_name(F.col("path")))
    named = F.nullif(F.regexp_extract("path", r"(historical|hybrid|ssp\d{3})", 1), F.lit(""))
    return files.withColumn("year", year).withColumn("scenario", F.coalesce(named, expr.scenario_of_year(F.col("year")))).orderBy(F.coalesce("year", F.lit(0)), "path")


def discovered(files: DataFrame) -> DataFrame:
    """region, variable, sorted distinct years."""
    return files.groupBy("region", "variable").agg(F.sort_array(F.collect_set("year")).alias("years"))


def expected_years(spark: SparkSession, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """scenario, year of every expected file."""
    rows = spark.createDataFrame([(s, a, b) for s, (a, b) in ranges.items()], "scenario string, a int, b int")
    return rows.select("scenario", F.explode(F.sequence("a", "b")).alias("year"))


def missing_files(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (scenario, year) without a file."""
    return expected.join(files.select("scenario", "year").distinct(), ["scenario", "year"], "left_anti")


def first_of_year(files: DataFrame, year: int) -> DataFrame:
    """The first file of a year by path."""
    return files.where(F.col("year") == year).orderBy("path").limit(1)


def catalogue_page(files: DataFrame, variables: tuple[str, ...] = (), regions: tuple[str, ...] = (), scenarios: tuple[str, ...] = (), years: tuple[int, int] | None = None, min_quality: float | None = None, status: tuple[str, ...] = (), order: str = "id", descending: bool = False, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of the catalogue: filters, a total order (ties by id), offset and limit; every row carries the total.

    has_more tells whether rows follow the page.
    """
    kept = files
    for column, allowed in (("variable", variables), ("region", regions), ("scenario", scenarios), ("status", status)):
        if allowed:
            kept = kept.where(F.col(column).isin(*allowed))
    if years:
        kept = kept.where(F.col("year").between(*years))
    if min_quality is not None:
        kept = kept.where(F.col("quality") >= min_quality)
    total = kept.agg(F.count("*")).scalar()
    page = kept.orderBy(F.col(order).desc() if descending else F.col(order), "id").offset(offset).limit(limit)
    return page.withColumn("total", total).withColumn("has_more", F.col("total") > offset + limit)


def data_summary(files: DataFrame) -> DataFrame:
    """region, variable, files, scenarios, first and last year."""
    return files.groupBy("region", "variable").agg(F.count("*").alias("files"), F.sort_array(F.collect_set("scenario")).alias("scenarios"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def processing_tasks(files: DataFrame, regions: DataFrame) -> DataFrame:
    """Every historical file up to 2014 and every projection after it, for each of a few regions."""
    wanted = ((F.col("scenario") == "historical") & (F.col("year") <= 2014)) | (F.col("scenario").isin("ssp245", "ssp585") & (F.col("year") >= 2015))
    return files.where(wanted).withColumn("region", F.explode(regions.agg(F.collect_list("region")).scalar()))


def expected_counties(key: str) -> int:
    """How many counties a region should have."""
    return region(key).counties


def validation_csv(spark: SparkSession, path: str) -> DataFrame:
    """County tables of all CSV files below a path; the schema keeps leading zeros of geoid."""
    from stratus.schema import COUNTY_YEAR, with_geoid

    return with_geoid(spark.read.csv(path, schema=COUNTY_YEAR, header=True, recursiveFileLookup=True, pathGlobFilter="*.csv", enforceSchema=False))


def load_counties(spark: SparkSession, path: str, regions: tuple[str, ...] = ()) -> DataFrame:
    """County boundaries from Parquet, with geoid filled to five characters; of GeoParquet the binary column geometry becomes rings."""
    from stratus.operators.spatial import counties_of_region
    from stratus.schema import standard_names, with_geoid
    from stratus.sources.shapes import from_wkb

    df = with_geoid(standard_names(spark.read.parquet(path)))
    if dict(df.dtypes).get("geometry") == "binary":
        df = from_wkb(df)
    return counties_of_region(df, *regions) if regions else df


def availability_rates(expected: DataFrame, listing: DataFrame, at_least: float = 0.95, readable: float = 0.9) -> DataFrame:
    """One row: share of expected paths that exist, share of those with bytes, and whether both suffice."""
    g = expected.select("path").distinct().join(listing.select("path", "size"), "path", "left")
    s = g.agg(F.count("*").alias("expected"), F.count("size").alias("existing"), F.count_if(F.col("size") > 0).alias("readable"))
    exists = F.col("existing") / F.nullif(F.col("expected"), F.lit(0))
    reads = F.col("readable") / F.nullif(F.col("existing"), F.lit(0))
    return s.select("expected", "existing", "readable", exists.alias("existence_rate"), reads.alias("readability_rate"), F.coalesce((exists >= at_least) & (reads >= readable), F.lit(False)).alias("passed"))


def output_summary(listing: DataFrame, small_bytes: int = 1_000_000) -> DataFrame:
    """extension, files, bytes and how many files are suspiciously small."""
    return listing.groupBy(F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("extension")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.count_if(F.col("size") < small_bytes).alias("small"))
