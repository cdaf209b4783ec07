"""The task manifest: an append-only Parquet table of events, read as the latest event of each task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "task_id string, stage string, region string, variable string, scenario string, status string, at timestamp, output string, error string"
KEYS = ("stage", "region", "variable", "scenario")


def latest(events: DataFrame) -> DataFrame:
    """The latest event of each task; at the same moment the further status counts."""
    order = F.array_position(F.array(*[F.lit(s) for s in ("pending", "running", "failed", "completed")]), F.col("status"))
    w = Window.partitionBy(*KEYS).orderBy(F.desc("at"), order.desc())
    return events.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def pending(tasks: DataFrame, stage: str | None = None, region: str | None = None, variable: str | None = None) -> DataFrame:
    """Tasks that are neither completed nor running, of a stage, region or variable."""
    out = tasks.where(F.col("status").isin("pending", "failed"))
    for c, v in (("stage", stage), ("region", region), ("variable", variable)):
        out = out.where(F.col(c) == v) if v else out
    return out


class Manifest:
    """Every method that changes it appends rows; nothing is rewritten, so a lost writer leaves the earlier events whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _append(self, rows: DataFrame) -> None:
        named = rows.withColumns({"task_id": F.concat_ws("/", *KEYS), "at": F.current_timestamp()})
        have = set(rows.columns)
        extra = {c: F.lit(None).cast("string") for c in ("output", "error") if c not in have}
        named.withColumns(extra).select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.mode("append").parquet(self.path)

    def register(self, tasks: DataFrame) -> None:
        """Tasks (stage, region, variable, scenario) as pending."""
        self._append(tasks.select(*KEYS).distinct().withColumn("status", F.lit("pending")))

    def record(self, stage: str, region: str, variable: str, scenario: str, status: str, output: str | None = None, error: str | None = None) -> None:
        """Started, completed or failed."""
        if status not in ("running", "completed", "failed"):
            raise ValueError(f"unknown status {status}")
        one = self.spark.createDataFrame([(stage, region, variable, scenario, status, output, error)], "stage string, region string, variable string, scenario string, status string, output string, error string")
        self._append(one)

    def events(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def tasks(self) -> DataFrame:
        """The latest event of each task."""
        return latest(self.events())

    def pending(self, stage: str | None = None, region: str | None = None, variable: str | None = None) -> DataFrame:
        """Tasks that are neither completed nor running."""
        return pending(self.tasks(), stage, region, variable)

    def discover(self, outputs: DataFrame) -> None:
        """Marks the tasks completed whose outputs (stage, region, variable, scenario, output) exist."""
        self._append(outputs.join(self.tasks().where("status <> 'completed'").select(*KEYS), list(KEYS), "left_semi").withColumn("status", F.lit("completed")))
