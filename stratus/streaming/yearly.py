"""New yearly files as they arrive: a file stream that keeps daily climatologies up to date."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratus.operators.climatology import daily_climatology
from stratus.schema import GRID_DAILY
from stratus.sources.sinks import write_climatology

KEYS = ("variable", "scenario", "year")


def new_files(spark: SparkSession, path: str, schema: str = GRID_DAILY, files_a_batch: int = 64) -> DataFrame:
    """A stream of the readings in files that appear below a path."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).option("recursiveFileLookup", "true").parquet(path)


def keep_climatologies(spark: SparkSession, source: str, target: str, checkpoint: str, files_a_batch: int = 64) -> StreamingQuery:
    """Process everything new and stop. A year may be spread over files that arrive in any batch: each batch makes the partitions it has
    readings of again, from all files of the source, so repeating a batch after a failure gives the same table."""

    def batch(rows: DataFrame, _: int) -> None:
        keys = rows.select(*KEYS).distinct()
        every = rows.sparkSession.read.schema(GRID_DAILY).option("recursiveFileLookup", "true").parquet(source)
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"k.{k}")) for k in KEYS]
        touched = every.alias("r").join(keys.alias("k"), reduce(and_, same), "left_semi")
        write_climatology(daily_climatology(touched), target)

    return new_files(spark, source, files_a_batch=files_a_batch).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
