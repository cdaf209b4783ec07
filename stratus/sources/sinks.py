"""Writers: partitioned Parquet for data, CSV and JSON for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shuffled bytes for which a task writes, at most. Rows of few values take some thirty times that where they are sorted by partition.
TASK_BYTES = 8 << 20
_ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
NORMAL_KEYS = ("variable", "region", "period_type", "target_year")


def write_normals(df: DataFrame, path: str, keys: tuple[str, ...] = NORMAL_KEYS) -> None:
    """One folder a normal; only the partitions that df holds are replaced, so a run can be repeated.

    Rows are brought together by partition before writing, spread over tasks and files of about TASK_BYTES where one is large; the session's
    advised size is set to that for the time of the write.
    """
    conf = df.sparkSession.conf
    before = conf.get(_ADVISED, None)
    conf.set(_ADVISED, str(TASK_BYTES))
    try:
        df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    finally:
        conf.unset(_ADVISED) if before is None else conf.set(_ADVISED, before)


def write_climatology(df: DataFrame, path: str, keys: tuple[str, ...] = ("variable", "scenario", "year")) -> None:
    """Daily climatologies by year."""
    write_normals(df, path, keys)


def only_missing(planned: DataFrame, existing: DataFrame, keys: tuple[str, ...] = NORMAL_KEYS) -> DataFrame:
    """Planned outputs that are not there yet."""
    return planned.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def existing_partitions(df: DataFrame, keys: tuple[str, ...] = NORMAL_KEYS) -> DataFrame:
    """The partitions of a written table."""
    return df.select(*keys).distinct()


def write_county_csv(df: DataFrame, path: str) -> None:
    """A county time series as one CSV file in order; a report of bounded size."""
    df.orderBy("geoid", "year").coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_box_csv(df: DataFrame, path: str) -> None:
    """Box statistics as CSV."""
    df.write.mode("overwrite").csv(path, header=True)


def write_issues(found: DataFrame, path: str, fmt: str = "json") -> None:
    """Issues as JSON lines, or as CSV with the details as JSON text."""
    if fmt == "json":
        found.write.mode("overwrite").json(path)
    elif fmt == "csv":
        found.withColumn("details", F.to_json("details")).write.mode("overwrite").csv(path, header=True)
    else:
        raise ValueError(f"unknown format {fmt}")


def write_tasks(tasks: DataFrame, path: str, fmt: str = "json") -> None:
    """The manifest as JSON lines, or its status table as CSV."""
    if fmt == "json":
        tasks.write.mode("overwrite").json(path)
    else:
        flat = tasks.select(*[F.concat_ws(";", c).alias(c) if t.startswith("array") else F.col(c) for c, t in tasks.dtypes])
        flat.write.mode("overwrite").csv(path, header=True)


def report_rows(found: DataFrame, limit: int = 1000) -> list[dict]:
    """The issues for a rendered report by severity and category; beyond the limit, which a page sets, a last row tells how many follow."""
    rank = F.when(F.col("severity") == "CRITICAL", 0).when(F.col("severity") == "WARNING", 1).otherwise(2)
    rows = [r.asDict(recursive=True) for r in found.orderBy(rank, "validator", "category", "message").limit(limit + 1).collect()]
    if len(rows) > limit:
        rows[limit:] = [{"validator": "report", "severity": "INFO", "category": "Report", "message": f"{found.count() - limit} more issues are in the table", "details": {}}]
    return rows


def render_markdown(rows: list[dict], title: str = "Validation report") -> str:
    """A short report in Markdown."""
    lines = [f"# {title}", "", "| severity | validator | category | message |", "|-|-|-|-|"]
    return "\n".join([*lines, *(f"| {r['severity']} | {r['validator']} | {r['category']} | {r['message']} |" for r in rows), ""])


def render_html(rows: list[dict], title: str = "Validation report") -> str:
    """The same in HTML."""
    from html import escape

    body = "".join("<tr>" + "".join(f"<td>{escape(str(r[k]))}</td>" for k in ("severity", "validator", "category", "message")) + "</tr>" for r in rows)
    return f"<html><head><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1><table>{body}</table></body></html>"


def output_path(base: str, level: str, *parts: str, name: str = "") -> str:
    """base/L1_means|L2_metrics|L3_validation/parts/name."""
    folders = {"L1": "L1_means", "L2": "L2_metrics", "L3": "L3_validation"}
    if level not in folders:
        raise KeyError(f"unknown level {level}")
    return "/".join(p for p in (base.rstrip("/"), folders[level], *parts, name) if p)
