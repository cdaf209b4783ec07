"""Model time axes: offsets in units such as "days since 1850-01-01" under the calendars that climate models use, as Column arithmetic.

Calendars: noleap (365_day), all_leap (366_day), 360_day, and standard (gregorian, proleptic_gregorian), which here has no Julian part: dates
before 1582-10-15 are proleptic. Offsets may have fractions, and be negative; null, an unknown unit or an unknown calendar gives null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UNITS = r"^\s*(day|hour|minute|second)s?\s+since\s+(-?\d{1,4})-(\d{1,2})-(\d{1,2})(?:[t ]+(\d{1,2})(?::(\d{1,2}))?(?::(\d{1,2}(?:\.\d*)?))?)?"
# The names of calendars, days before each month in years of 365 and 366 days.
_CALENDARS = {"noleap": ("noleap", "365_day"), "all_leap": ("all_leap", "366_day"), "360_day": ("360_day",), "standard": ("standard", "gregorian", "proleptic_gregorian")}
_BEFORE = {365: (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334), 366: (0, 31, 60, 91, 121, 152, 182, 213, 244, 274, 305, 335)}
_A_DAY = {"day": 1.0, "hour": 24.0, "minute": 1440.0, "second": 86400.0}


def _is(calendar: Column, kind: str) -> Column:
    return F.lower(calendar).isin(*_CALENDARS[kind])


def _before(month: Column, length: int) -> Column:
    return F.get(F.array(*map(F.lit, _BEFORE[length])), month.cast("int") - 1)


def day_number(year: Column, month: Column, day: Column, calendar: Column) -> Column:
    """Days from the calendar's year 0 (of the standard one from 1970-01-01) to a date; null for dates that it hasn't."""
    y, d = year.cast("bigint"), day.cast("bigint")
    in_month = lambda n: (month >= 1) & (month <= 12) & (d >= 1) & (d <= n)
    lengths = {n: F.get(F.array(*[F.lit(b - a) for a, b in zip(_BEFORE[n], (*_BEFORE[n][1:], n), strict=True)]), month.cast("int") - 1) for n in (365, 366)}
    return (
        F.when(_is(calendar, "noleap") & in_month(lengths[365]), y * 365 + _before(month, 365) + d - 1)
        .when(_is(calendar, "all_leap") & in_month(lengths[366]), y * 366 + _before(month, 366) + d - 1)
        .when(_is(calendar, "360_day") & in_month(F.lit(30)), y * 360 + (month - 1) * 30 + d - 1)
        .when(_is(calendar, "standard"), F.unix_date(F.try_to_timestamp(F.format_string("%04d-%02d-%02d", y, month.cast("int"), d.cast("int"))).cast("date")).cast("bigint"))
    )


def days_of(offset: Column, units: Column, calendar: Column) -> Column:
    """The day number, with its fraction, that an offset stands for."""
    part = lambda i: F.nullif(F.regexp_extract(F.lower(units), _UNITS, i), F.lit(""))
    origin = day_number(part(2).cast("int"), part(3).cast("int"), part(4).cast("int"), calendar)
    clock = [F.coalesce(part(i).cast("double"), F.lit(0.0)) for i in (5, 6, 7)]
    a_day = F.element_at(F.create_map(*[x for k, n in _A_DAY.items() for x in (F.lit(k), F.lit(n))]), part(1))
    return origin + offset / a_day + clock[0] / 24 + clock[1] / 1440 + clock[2] / 86400


def date_of(days: Column, calendar: Column) -> Column:
    """Struct year, month, day, doy, hours of a day number. What lies within a microsecond of the next day belongs to it."""
    whole = F.floor(days + 1e-6 / 86400)

    def regular(n: int) -> Column:
        year = F.floor(whole / n)
        doy = whole - year * n + 1
        if n == 360:
            month = F.floor((doy - 1) / 30) + 1
            day = doy - (month - 1) * 30
        else:
            month = F.size(F.filter(F.array(*map(F.lit, _BEFORE[n])), lambda b: b < doy))
            day = doy - _before(month, n)
        return F.struct(*[c.cast("int").alias(a) for c, a in ((year, "year"), (month, "month"), (day, "day"), (doy, "doy"))])

    date = F.date_from_unix_date(whole.cast("int"))
    real = F.struct(F.year(date).alias("year"), F.month(date).alias("month"), F.dayofmonth(date).alias("day"), F.dayofyear(date).alias("doy"))
    found = F.when(_is(calendar, "noleap"), regular(365)).when(_is(calendar, "all_leap"), regular(366)).when(_is(calendar, "360_day"), regular(360)).when(_is(calendar, "standard"), real)
    held = F.when(days.isNotNull(), found)
    return F.when(held.isNotNull(), F.struct(*[held[f].alias(f) for f in ("year", "month", "day", "doy")], F.greatest((days - whole) * 24, F.lit(0.0)).alias("hours")))


def decoded_time(offset: Column, units: Column, calendar: Column) -> Column:
    """Struct year, month, day, doy, hours of an offset."""
    return date_of(days_of(offset, units, calendar), calendar)


def encoded_time(year: Column, month: Column, day: Column, units: Column, calendar: Column) -> Column:
    """The offset of the start of a date in its units; null for dates that the calendar hasn't."""
    part = F.nullif(F.regexp_extract(F.lower(units), _UNITS, 1), F.lit(""))
    a_day = F.element_at(F.create_map(*[x for k, n in _A_DAY.items() for x in (F.lit(k), F.lit(n))]), part)
    return (day_number(year, month, day, calendar) - days_of(F.lit(0.0), units, calendar)) * a_day


def time_axes(spark: SparkSession, path: str, glob: str = "*.nc") -> DataFrame:
    """path, units, calendar (standard where none is named) of the time axis of every grid file below a path, from headers alone."""
    from stratus.sources.grid_source import opened, opened_by_range

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                with opened_by_range(name) as stream:
                    rows.append((name, opened(stream).time_attributes()))
            yield pa.record_batch([pa.array([n for n, _ in rows]), pa.array([a.get("units") for _, a in rows], pa.string()), pa.array([a.get("calendar") or "standard" for _, a in rows])], names=["path", "units", "calendar"])

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path")
    return found.mapInArrow(run, "path string, units string, calendar string")


def with_dates(grids: DataFrame, axes: DataFrame) -> DataFrame:
    """The cells of sources.grid_source with date, the struct of decoded_time(), by the axis of their file."""
    return grids.join(axes, "path").withColumn("date", decoded_time(F.col("time"), F.col("units"), F.col("calendar"))).drop("units", "calendar")
