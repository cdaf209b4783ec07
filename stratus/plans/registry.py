"""Registered queries. A column list fixes names and types on both sides: s text, i long, d double rounded to six places, b boolean."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
DIGITS = 6


def typed(df: DataFrame, columns: str) -> DataFrame:
    """Select and cast the columns of a list such as "geoid:s year:i mean:d"."""
    out = []
    for name, kind in (c.split(":") for c in columns.split()):
        c = F.col(f"`{name}`")
        out.append({"s": c.cast("string"), "i": c.cast("bigint"), "d": F.round(c.cast("double"), DIGITS) + F.lit(0.0), "b": c.cast("boolean")}[kind].alias(name))
    return df.select(*out)


def typed_sql(body: str, columns: str, ctes: str = "") -> str:
    """The same select over a DuckDB query."""
    out = []
    for name, kind in (c.split(":") for c in columns.split()):
        c = f'"{name}"'
        out.append({"s": f"cast({c} as varchar)", "i": f"cast({c} as bigint)", "d": f"round(cast({c} as double), {DIGITS}) + 0.0", "b": f"cast({c} as boolean)"}[kind] + f" as {c}")
    return f"with {ctes + ', ' if ctes else ''}q as ({body}) select {', '.join(out)} from q"


def query(columns: str, body: str | None = None, ctes: str = "") -> Callable:
    """Register a function (spark, sf_dir) -> DataFrame under its name, with SQL if there is a body."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return typed(f(spark, sf_dir), columns)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if body:
            SQL[f.__name__] = typed_sql(body, columns, ctes)
        return run

    return register
