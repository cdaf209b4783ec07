"""Annual indicators by cell and their means by county, described as data.

A metric is a column transform, a reduction over the days of a cell and, for day counts, a global quantile with a
comparison. All metrics of a table are computed in one aggregation by cell and one by county, against quantiles that
were found exactly beforehand in a few shared passes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import expr


@dataclass(frozen=True)
class Metric:
    """reduction: avg, min, max, sum, gdd or days; days compares with the quantile q by above or below, strictly."""

    name: str
    variable: str
    reduction: str
    q: float | None = None
    above: bool = True
    base: float = 10.0

    @property
    def threshold(self) -> str | None:
        return None if self.q is None else f"p{round(self.q * 100)}_{self.variable}"


METRICS = {
    m.name: m
    for m in (
        Metric("mean_temp_c", "tas", "avg"),
        Metric("growing_degree_days", "tas", "gdd"),
        Metric("min_temp_c", "tasmin", "min"),
        Metric("max_temp_c", "tasmax", "max"),
        Metric("annual_precip_mm", "pr", "sum"),
        Metric("high_temp_days_p90", "tasmax", "days", 0.90),
        Metric("high_temp_days_p95", "tasmax", "days", 0.95),
        Metric("low_temp_days_p10", "tasmin", "days", 0.10, False),
        Metric("low_temp_days_p5", "tasmin", "days", 0.05, False),
        Metric("low_temp_days_p1", "tasmin", "days", 0.01, False),
        Metric("wet_days_p95", "pr", "days", 0.95),
    )
}
UNITS: dict[str, Callable[[Column], Column]] = {"tas": expr.celsius, "tasmax": expr.celsius, "tasmin": expr.celsius, "pr": expr.mm_a_day}


def available(variable: str) -> list[str]:
    """Names of a variable's metrics."""
    return [m.name for m in METRICS.values() if m.variable == variable]


BAND_ROWS = 100_000
SKETCH_ERROR = 0.0001
CUTS = 1000


@dataclass
class _Band:
    """A stretch of a column's values that holds the ranks sought, low and high included; inside: at most so many rows strictly between."""

    column: str
    share: float
    ranks: list[int]
    low: float
    high: float
    inside: float
    found: dict[int, float]

    def counts(self, x: str) -> list[Column]:
        """What a pass counts in and below the band, and the values between, or a sketch of them where they may be too many."""
        c = F.col(self.column)
        between = (c > self.low) & (c < self.high)
        out = [F.count_if(c < self.low).alias(f"less_{x}"), F.count_if(c == self.low).alias(f"low_{x}"), F.count_if(between).alias(f"in_{x}"), F.count_if((c == self.high) & (c > self.low)).alias(f"high_{x}")]
        if self.inside <= BAND_ROWS:
            return [*out, F.collect_list(F.when(between, c.cast("double"))).alias(f"values_{x}")]
        return [*out, F.percentile_approx(F.when(between, c), F.array(*[F.lit(j / CUTS) for j in range(CUTS + 1)]), int(1 / SKETCH_ERROR)).alias(f"cuts_{x}")]

    def narrow(self, got, x: str, least: float, most: float, n: int) -> None:
        """Take the ranks that a pass decided; make the band smaller around those that are left."""
        less, low, inside, high = (got[f"{y}_{x}"] for y in ("less", "low", "in", "high"))
        values = sorted(got[f"values_{x}"]) if self.inside <= BAND_ROWS else None
        left = []
        for r in self.ranks:
            at = r - less - low
            if -low <= at < 0:
                self.found[r] = float(self.low)
            elif inside <= at < inside + high:
                self.found[r] = float(self.high)
            elif 0 <= at < inside and values is not None:
                self.found[r] = values[at]
            else:
                left.append(r)
        self.ranks = left
        if not left:
            return
        if left[0] < less:
            # The sketch missed: the band is all that is below, or above.
            self.low, self.high, self.inside = least, self.low, less
        elif left[-1] >= less + low + inside + high:
            self.low, self.high, self.inside = self.high, most, n - less - low - inside - high
        else:
            cuts = got[f"cuts_{x}"]
            at = [(r - less - low + 1) / inside * CUTS for r in left]
            j0, j1 = int(at[0] - 2 * SKETCH_ERROR * CUTS) - 1, int(at[-1] + 2 * SKETCH_ERROR * CUTS) + 2
            self.low, self.high = cuts[j0] if j0 >= 0 else self.low, cuts[j1] if j1 <= CUTS else self.high
            self.inside = inside * ((j1 - j0) / CUTS + 2 * SKETCH_ERROR)


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Exact quantiles (name: column, q), linear between neighbours, of a table of any size; NULL for a column without values.

    The first pass counts and sketches; for each quantile two sketched values enclose its ranks, with at most a share of 4 * SKETCH_ERROR of
    the rows strictly between them. A second pass counts what is below them and equal to them, and takes the values between, if those
    are at most BAND_ROWS. Where they may be more, passes in between sketch the band alone. All quantiles share each pass, so tables
    of up to BAND_ROWS / (4 * SKETCH_ERROR) rows take two passes, and each further one serves some 200 times as many.
    """
    if not wanted:
        return {}
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    cells = [f(c).alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in (("n", F.count), ("a", F.min), ("b", F.max))]
    cells += [F.percentile_approx(c, F.array(*[F.lit(min(1.0, max(0.0, q + d))) for d in (-SKETCH_ERROR, SKETCH_ERROR)]), int(1 / SKETCH_ERROR)).alias(f"cut_{i}") for i, (c, q) in enumerate(wanted.values())]
    first = df.agg(*cells).first()
    size = {c: (first[f"a_{i}"], first[f"b_{i}"], first[f"n_{i}"]) for i, c in enumerate(columns)}
    bands = {}
    for i, (k, (c, q)) in enumerate(wanted.items()):
        if n := size[c][2]:
            low = int(q * (n - 1))
            bands[k] = _Band(c, q * (n - 1) - low, sorted({low, min(low + 1, n - 1)}), *first[f"cut_{i}"], 4 * SKETCH_ERROR * n + 2, {})
    for _ in range(100):
        open_ = {f"{i}": b for i, b in enumerate(bands.values()) if b.ranks}
        if not open_:
            break
        got = df.agg(*[x for i, b in open_.items() for x in b.counts(i)]).first()
        for i, b in open_.items():
            b.narrow(got, i, *size[b.column])
    else:
        raise RuntimeError("quantiles were not enclosed")
    ends = {k: (b.found[min(b.found)], b.found[max(b.found)], b.share) for k, b in bands.items()}
    return dict.fromkeys(wanted) | {k: v + (w - v) * share for k, (v, w, share) in ends.items()}


def thresholds(df: DataFrame, metrics: list[Metric]) -> dict[str, float | None]:
    """The exact global quantile of each day-count metric, by threshold name; runs the passes of exact_quantiles()."""
    return exact_quantiles(df, {m.threshold: (m.variable, m.q) for m in metrics if m.q is not None})


def in_metric_units(df: DataFrame) -> DataFrame:
    """Celsius and millimetres a day for the variables that are present."""
    return df.withColumns({v: f(F.col(v)) for v, f in UNITS.items() if v in df.columns})


def _reduced(m: Metric, nan_as_zero: bool) -> Column:
    v = F.col(m.variable)
    if m.reduction == "days":
        hit = v > F.col(m.threshold) if m.above else v < F.col(m.threshold)
        out = F.sum(F.when(v.isNotNull(), hit.cast("bigint")))
    elif m.reduction == "gdd":
        out = F.sum(F.greatest(v - m.base, F.when(v.isNotNull(), F.lit(0.0))))
    else:
        out = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}[m.reduction](v)
    return F.coalesce(out, F.lit(0)) if nan_as_zero and m.reduction in ("days", "gdd", "sum") else out


def cell_metrics(df: DataFrame, names: list[str], keys: tuple[str, ...], cuts: dict[str, float | None] | None = None, nan_as_zero: bool = False) -> DataFrame:
    """One row a cell (keys hold its coordinates) with a column for each metric, and each threshold used.

    df is in metric units. Thresholds are taken from `cuts` or found in df. A cell with only NULL has NULL metrics; nan_as_zero gives it
    zero sums and day counts instead.
    """
    metrics = [METRICS[n] for n in names]
    used = list(dict.fromkeys(m.threshold for m in metrics if m.q is not None))
    if used:
        cuts = thresholds(df, metrics) if cuts is None else cuts
        df = df.withColumns({t: F.lit(cuts[t]).cast("double") for t in used})
    return df.groupBy(*keys).agg(*[_reduced(m, nan_as_zero).alias(m.name) for m in metrics], *[F.lit(cuts[t]).cast("double").alias(t) for t in used])


def county_metrics(cells: DataFrame, names: list[str], keys: tuple[str, ...]) -> DataFrame:
    """County means of the cell metrics in long form: keys, variable, metric, value, threshold, pixel_count."""
    means = cells.groupBy(*keys).agg(
        *[F.avg(n).alias(f"v_{n}") for n in names],
        *[F.count(n).alias(f"n_{n}") for n in names],
        *[F.first(t, ignorenulls=True).alias(t) for t in dict.fromkeys(METRICS[n].threshold for n in names if METRICS[n].q is not None)],
    )
    rows = F.array(*[F.struct(F.lit(METRICS[n].variable).alias("variable"), F.lit(n).alias("metric"), F.col(f"v_{n}").cast("double").alias("value"), (F.col(METRICS[n].threshold) if METRICS[n].q is not None else F.lit(None)).cast("double").alias("threshold"), F.col(f"n_{n}").alias("pixel_count")) for n in names])
    return means.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def wide(long: DataFrame, names: list[str], keys: tuple[str, ...]) -> DataFrame:
    """One row a county with a value, threshold and pixel count for each metric; a known metric list spares a pass."""
    return long.groupBy(*keys).pivot("metric", names).agg(F.first("value").alias("value"), F.first("threshold").alias("threshold"), F.first("pixel_count").alias("pixel_count"))


def precipitation_spread(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Mean, least and greatest annual precipitation of a county's cells."""
    c = F.col("annual_precip_mm")
    return cells.groupBy(*keys).agg(F.avg(c).alias("precip_mean"), F.min(c).alias("precip_min"), F.max(c).alias("precip_max"), F.count(c).alias("pixel_count"))


def box_statistics(df: DataFrame, value: str, keys: tuple[str, ...], percentiles: tuple[float, ...] = ()) -> DataFrame:
    """Count, mean, population deviation (0 for one value), least, greatest and exact percentiles by group; groups without values drop."""
    v = F.col(value)
    extra = [F.percentile(v, F.array(*[F.lit(p / 100) for p in percentiles])).alias("__p")] if percentiles else []
    out = df.where(v.isNotNull()).groupBy(*keys).agg(F.count(v).alias("num_grid_points"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), *extra)
    for i, p in enumerate(percentiles):
        out = out.withColumn(f"p{p:g}", F.col("__p")[i])
    return out.drop("__p")
