"""Trends and breaks of yearly series: Mann-Kendall with Sen's slope, and change points by penalised segmentation.

A series is the yearly means of a group's rows, so it has as many values as there are years; it is collected in one row and worked on in numpy, many
series a task. Rows without a value or a year don't count. Groups without a value give no row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Two-sided, of the normal distribution.
SIGNIFICANCE = 0.05
#: Segments have at least so many years, and their cost is weighed by this times the logarithm of the series' length.
LEAST_YEARS = 5
PENALTY = 3.0


def series_of(rows: DataFrame, value: str, keys: tuple[str, ...], year: str = "year") -> DataFrame:
    """The keys, years and values (arrays in order of year); two steps of aggregation on the keys."""
    yearly = rows.where(F.col(value).isNotNull() & F.col(year).isNotNull()).groupBy(*keys, F.col(year).cast("int").alias("__year")).agg(F.avg(value).alias("__value"))
    held = F.sort_array(F.collect_list(F.struct("__year", "__value")))
    return yearly.groupBy(*keys).agg(held.alias("s")).select(*keys, F.col("s.__year").alias("years"), F.col("s.__value").alias("values"))


def _each(series: DataFrame, work: Callable[[np.ndarray, np.ndarray], list[tuple]], columns: str) -> DataFrame:
    """work(years, values) -> rows, beside the keys."""
    keys = [f for f in series.schema if f.name not in ("years", "values")]
    names = [c.split()[0] for c in columns.split(", ")]
    types = [{"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}[c.split()[1]] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, of = [], []
            for i, (years, values) in enumerate(zip(batch.column("years"), batch.column("values"), strict=True)):
                rows = work(np.asarray(years.as_py(), dtype=float), np.asarray(values.as_py(), dtype=float))
                found += rows
                of += [i] * len(rows)
            at = pa.array(of, pa.int64())
            made = [pa.array([r[j] for r in found], t) for j, t in enumerate(types)]
            yield pa.record_batch([*(batch.column(k.name).take(at) for k in keys), *made], names=[*(k.name for k in keys), *names])

    return series.mapInArrow(run, ", ".join([*(f"`{k.name}` {k.dataType.simpleString()}" for k in keys), columns]))


def kendall(years: np.ndarray, values: np.ndarray) -> tuple[int, int, float, float, float, float]:
    """n, s, variance with ties, z with continuity, two-sided p, Sen's slope a year (NaN for one value)."""
    n = len(values)
    i, j = np.triu_indices(n, 1)
    rise = values[j] - values[i]
    s = int(np.sign(rise).sum())
    ties = np.unique(values, return_counts=True)[1].astype(float)
    variance = float((n * (n - 1) * (2 * n + 5) - (ties * (ties - 1) * (2 * ties + 5)).sum()) / 18)
    z = (s - np.sign(s)) / math.sqrt(variance) if variance > 0 else 0.0
    slope = float(np.median(rise / (years[j] - years[i]))) if n > 1 else math.nan
    return n, s, variance, float(z), math.erfc(abs(z) / math.sqrt(2)), slope


def mann_kendall(rows: DataFrame, value: str, keys: tuple[str, ...], year: str = "year", significance: float = SIGNIFICANCE) -> DataFrame:
    """The keys, n, s, variance, z, p, slope, trend: increasing, decreasing or no_trend at the significance asked for."""

    def work(years: np.ndarray, values: np.ndarray) -> list[tuple]:
        n, s, variance, z, p, slope = kendall(years, values)
        trend = "no_trend" if p >= significance else "increasing" if s > 0 else "decreasing"
        return [(n, s, variance, z, p, None if math.isnan(slope) else slope, trend)]

    return _each(series_of(rows, value, keys, year), work, "n bigint, s bigint, variance double, z double, p double, slope double, trend string")


def segments(values: np.ndarray, penalty: float, least: int) -> list[int]:
    """Where the segments of the cheapest cut begin: squared deviations from the segments' means plus the penalty a cut; of equal cuts the one with fewer and earlier ones.

    Exact, by optimal partitioning: the cheapest cut of the first k values is made from those of fewer.
    """
    n = len(values)
    if n < 2 * least:
        return [0]
    centred = values - values.mean()
    total, square = np.concatenate([[0.0], np.cumsum(centred)]), np.concatenate([[0.0], np.cumsum(centred * centred)])
    best, before = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=int)
    best[0] = -penalty
    for end in range(least, n + 1):
        start = np.arange(0, end - least + 1)
        m = end - start
        cost = best[start] + penalty + np.maximum(square[end] - square[start] - (total[end] - total[start]) ** 2 / m, 0.0)
        k = int(np.argmin(cost))
        # A cut must gain something beyond rounding.
        k = 0 if k and cost[0] <= cost[k] + 1e-9 * (1 + square[-1]) else k
        best[end], before[end] = cost[k], start[k]
    out, at = [], n
    while at > 0:
        at = int(before[at])
        out.append(at)
    return out[::-1]


def noise(values: np.ndarray) -> float:
    """Variance of the values around their segments' means by the differences of neighbours, which few breaks don't disturb: from the median absolute difference, or the mean square one where that is zero."""
    steps = np.abs(np.diff(values))
    middle = float(np.median(steps)) if len(steps) else 0.0
    return (middle / 0.9538726) ** 2 if middle > 0 else float((steps**2).mean() / 2) if len(steps) else 0.0


def change_points(rows: DataFrame, value: str, keys: tuple[str, ...], year: str = "year", penalty: float = PENALTY, least: int = LEAST_YEARS) -> DataFrame:
    """The keys, segment (from 1), first_year, last_year, n, mean, shift (from the segment before; null for the first), severity.

    The penalty of a cut is `penalty` times the noise of the series times the logarithm of its length. A shift's severity is by its ratio to the
    root of the noise: minor below 2, moderate below 4, severe from there on; none for the first segment.
    """

    def work(years: np.ndarray, values: np.ndarray) -> list[tuple]:
        spread = noise(values)
        starts = segments(values, penalty * spread * math.log(len(values)), least) if spread > 0 else [0]
        out = []
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(values)], strict=True)):
            mean = float(values[a:b].mean())
            shift = mean - out[-1][4] if k else None
            ratio = abs(shift) / math.sqrt(spread) if k else 0.0
            out.append((k + 1, int(years[a]), int(years[b - 1]), b - a, mean, shift, "none" if not k else "minor" if ratio < 2 else "moderate" if ratio < 4 else "severe"))
        return out

    return _each(series_of(rows, value, keys, year), work, "segment int, first_year int, last_year int, n bigint, mean double, shift double, severity string")
