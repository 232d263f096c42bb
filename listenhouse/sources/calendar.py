"""The hourly grid behind the calendar dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The grid used when nothing else is asked for: five full years of hours.
FIRST_HOUR = datetime(2020, 1, 1)
LAST_HOUR = datetime(2024, 12, 31, 23)


def calendar_hours(
    spark: SparkSession, first: datetime = FIRST_HOUR, last: datetime = LAST_HOUR,
    dtype: str = "timestamp_ntz",
) -> DataFrame:
    """Hours from ``first`` to ``last``, both included, built on executors."""
    hours = int((last - first).total_seconds() // 3600) + 1
    start = F.lit(first.isoformat(sep=" ")).cast(dtype)
    step = F.make_dt_interval(F.lit(0), F.col("id").cast("int"), F.lit(0), F.lit(0))
    return spark.range(hours).select((start + step).alias("datetime"))


def occurring_years(events: DataFrame, ts: str = "ts") -> DataFrame:
    """The years the events fall in, one row each; a stray time adds its own year only."""
    return events.select(F.year(ts).alias("year")).where("year is not null").distinct()


def _hour(dtype: str, year: Column, days: Column, hours: Column) -> Column:
    first = F.make_timestamp_ntz(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return (first + F.make_dt_interval(days, hours, F.lit(0), F.lit(0))).cast(dtype)


def calendar_of_years(years: DataFrame, dtype: str = "timestamp_ntz") -> DataFrame:
    """All hours of the given years: a row per day, then one per hour."""
    length = F.when(F.dayofyear(F.make_date("year", F.lit(12), F.lit(31))) == 366, 365).otherwise(364)
    days = years.select("year", F.explode(F.sequence(F.lit(0), length)).alias("day"))
    hours = days.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return hours.select(_hour(dtype, F.col("year"), F.col("day"), F.col("hour")).alias("datetime"))


def calendar_hours_sequence(years: DataFrame, dtype: str = "timestamp_ntz") -> DataFrame:
    """The same grid as one exploded array per year."""
    first = lambda y: _hour(dtype, y, F.lit(0), F.lit(0))
    hour = F.expr("interval 1 hour")
    hours = F.sequence(first(F.col("year")), first(F.col("year") + 1) - hour, hour)
    return years.select(F.explode(hours).alias("datetime"))
