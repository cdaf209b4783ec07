"""Spells of days and drought indices.

A day is known by its number: year * 365 + day of the year - 1, so that spells run on from one year into the next.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions.expr import celsius, mm_a_day

#: Months with rain that a gamma distribution is fitted to at least.
LEAST_MONTHS = 4
#: Bounds of the index, as usual for what lies beyond the fitted sample.
FARTHEST = 3.09

HEAT_C, COLD_C, WET_MM = 35.0, 0.0, 1.0
# Days before each month of a 365-day year.
MONTH_STARTS = (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)


def day_number(year: Column, doy: Column) -> Column:
    return year.cast("bigint") * 365 + F.least(doy.cast("bigint"), F.lit(365)) - 1


def hot(tasmax: Column, limit: float = HEAT_C) -> Column:
    return celsius(tasmax) > limit


def cold(tasmin: Column, limit: float = COLD_C) -> Column:
    return celsius(tasmin) < limit


def dry(pr: Column, limit: float = WET_MM) -> Column:
    return mm_a_day(pr) < limit


def spells(rows: DataFrame, flag: Column, keys: tuple[str, ...], year: str = "year", doy: str = "doy", at_least: int = 1) -> DataFrame:
    """The keys, first, last (day numbers), days of each unbroken run of flagged days.

    A day is flagged where any of its rows is; a day without rows, or with null flags alone, breaks a run. Flagged days less their rank are the
    same along a run. All steps are grouped by the keys, so there is one shuffle of flagged days.
    """
    days = rows.where(flag).select(*keys, day_number(F.col(year), F.col(doy)).alias("__day")).where(F.col("__day").isNotNull())
    # Repeated days share a rank, so nothing is made distinct first.
    run = F.col("__day") - F.dense_rank().over(Window.partitionBy(*keys).orderBy("__day"))
    found = days.withColumn("__run", run).groupBy(*keys, "__run").agg(F.min("__day").alias("first"), F.max("__day").alias("last"))
    return found.select(*keys, "first", "last", (F.col("last") - F.col("first") + 1).alias("days")).where(F.col("days") >= at_least)


def spells_by_year(found: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The keys, year, events, days, longest of spells by the year in which they begin; a spell counts whole where it begins. Years without spells have no row."""
    year = F.floor(F.col("first") / 365).cast("int").alias("year")
    return found.groupBy(*keys, year).agg(F.count("*").alias("events"), F.sum("days").alias("days"), F.max("days").alias("longest"))


def month_of(doy: Column) -> Column:
    """Month of a day in a year of 365 days; day 366 belongs to December."""
    return F.size(F.filter(F.array(*map(F.lit, MONTH_STARTS)), lambda b: b < F.least(doy, F.lit(365))))


def monthly_totals(rows: DataFrame, value: Column, keys: tuple[str, ...], year: str = "year", doy: str = "doy") -> DataFrame:
    """The keys, year, month, total of the daily values; null ones add nothing, a month of nothing else has no row."""
    return rows.where(value.isNotNull()).groupBy(*keys, F.col(year).alias("year"), month_of(F.col(doy)).alias("month")).agg(F.sum(value).alias("total"))


def accumulated(monthly: DataFrame, keys: tuple[str, ...], months: int) -> DataFrame:
    """Totals over so many months up to each; where one of them has no row there is none."""
    w = Window.partitionBy(*keys).orderBy("__at").rangeBetween(1 - months, 0)
    at = F.col("year").cast("bigint") * 12 + F.col("month") - 1
    sums = monthly.withColumn("__at", at).select("*", F.sum("total").over(w).alias("__sum"), F.count("*").over(w).alias("__n"))
    return sums.where(F.col("__n") == months).select(*keys, "year", "month", F.col("__sum").alias("total"))


def gamma_fits(totals: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The keys, month, n, dry (share of months without rain), shape, scale: Thom's maximum-likelihood estimates from sums and sums of logarithms, one aggregation.

    Shape and scale are null for fewer than LEAST_MONTHS months with rain, or where all these are alike.
    """
    wet = F.col("total") > 0
    sums = totals.groupBy(*keys, "month").agg(F.count("*").alias("n"), F.count_if(wet).alias("wet"), F.avg(F.when(wet, F.col("total"))).alias("mean"), F.avg(F.when(wet, F.log("total"))).alias("logs"))
    a = F.log("mean") - F.col("logs")
    enough = (F.col("wet") >= LEAST_MONTHS) & (a > 1e-12)
    shape = F.when(enough, (1 + F.sqrt(1 + 4 * F.greatest(a, F.lit(0.0)) / 3)) / (4 * F.nullif(a, F.lit(0.0))))
    return sums.select(*keys, "month", "n", (1 - F.col("wet") / F.col("n")).alias("dry"), shape.alias("shape"), (F.col("mean") / shape).alias("scale"))


def drought_index(totals: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The keys, year, month, total, index: the normal score of each total within its calendar month (standardised precipitation index).

    A total's probability is the share of dry months plus, for the rest, the fitted gamma distribution's; that of no rain is the dry share.
    Scores end at -FARTHEST and FARTHEST; there is none where no distribution fits. One aggregation and a join on the keys and the month.
    """
    fitted = totals.join(gamma_fits(totals, keys), [*keys, "month"])
    names = [*keys, "year", "month", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, dry_share, shape, scale = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("total", "dry", "shape", "scale"))
            known = ~np.isnan(shape)
            p = np.full(len(total), np.nan)
            p[known] = dry_share[known] + (1 - dry_share[known]) * gamma_share(shape[known], np.maximum(total[known], 0) / scale[known])
            score = np.clip(normal_score(p), -FARTHEST, FARTHEST)
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array(score, from_pandas=True)], names=[*names, "index"])

    fields = {f.name: f.dataType.simpleString() for f in fitted.schema}
    return fitted.select(*names, "dry", "shape", "scale").mapInArrow(run, ", ".join([*(f"`{n}` {fields[n]}" for n in names), "index double"]))


def gamma_share(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The regularised lower incomplete gamma function P(a, x): its series below a + 1, the continued fraction of the rest above."""
    out = np.zeros(len(x))
    front = np.exp(a * np.log(np.where(x > 0, x, 1)) - x - np.array([math.lgamma(v) for v in a]))
    low = (x > 0) & (x < a + 1)
    if low.any():
        al, xl = a[low], x[low]
        term = total = 1 / al
        n = 0
        while n < 10_000 and (term > total * 1e-16).any():
            n += 1
            term = term * xl / (al + n)
            total = total + term
        out[low] = front[low] * total
    high = x >= a + 1
    if high.any():
        ah, xh = a[high], x[high]
        b = xh + 1 - ah
        c, d = np.full(len(b), 1e300), 1 / b
        h, n, step = d.copy(), 0, np.zeros(len(b))
        while n < 10_000 and (np.abs(step - 1) > 1e-15).any():
            n += 1
            an = n * (ah - n)
            b = b + 2
            d = 1 / (an * d + b)
            c = b + an / c
            step = c * d
            h = h * step
        out[high] = 1 - front[high] * h
    return out


def normal_score(p: np.ndarray) -> np.ndarray:
    """The standard normal quantile of p, by Newton's steps on the error function from a start by a logistic; infinite at 0 and 1, NaN for NaN."""
    out = np.full(len(p), np.nan)
    out[p <= 0], out[p >= 1] = -np.inf, np.inf
    inner = (p > 0) & (p < 1)
    # Of the smaller tail, so that nothing is lost near one.
    tail = np.minimum(p[inner], 1 - p[inner])
    x = np.maximum(np.log(tail / (1 - tail)) / 1.702, -np.sqrt(-2 * np.log(tail)))
    for _ in range(60):
        below = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x])
        density = np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
        # Newton's step on the logarithm of the tail, which is concave, so that it can't run away.
        step = (np.log(below) - np.log(tail)) * below / density
        x = x - step
        if len(x) == 0 or np.abs(step).max() < 1e-13:
            break
    out[inner] = np.where(p[inner] <= 0.5, x, -x)
    return out
