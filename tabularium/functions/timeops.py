"""Calendars, period arithmetic and time zones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STEP = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "hour": "INTERVAL 1 HOUR"}


def calendar(spark: SparkSession, low: str, high: str, step: str = "day", name: str = "day") -> DataFrame:
    """One row per period from `low` to `high`, both included."""
    periods = F.sequence(F.lit(low).cast("date"), F.lit(high).cast("date"), F.expr(_STEP[step]))
    return spark.range(1).select(F.explode(periods).alias(name))


def calendar_of(df: DataFrame, day: str, step: str = "day", name: str | None = None) -> DataFrame:
    """One row per period between the first and last date of `df[day]`."""
    bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr(_STEP[step]))).alias(name or day))


def fill_periods(spine: DataFrame, key: str, folded: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """The spine with the folded values, and defaults for periods that have none."""
    return spine.join(folded, key, "left").na.fill(dict(defaults))


def fill_gaps(folded: DataFrame, day: str, defaults: Mapping[str, object]) -> DataFrame:
    """Folded daily rows with a row for every absent day."""
    return fill_periods(calendar_of(folded, day), day, folded, defaults)


def add_month(ts: Column, n: int = 1) -> Column:
    """Same time n months later; the day is clamped to the end of a shorter month."""
    return ts + F.make_ym_interval(F.lit(0), F.lit(n))


def calendar_days(later: Column, earlier: Column) -> Column:
    """Difference of calendar dates; the exact duration is `later - earlier`."""
    return F.datediff(later, earlier).cast("long")


def late_days(actual: Column, promised: Column) -> Column:
    return F.greatest(calendar_days(actual, promised), F.lit(0).cast("long"))


def month_number(month: Column, first: Column) -> Column:
    """Whole months between two month starts."""
    return ((F.year(month) - F.year(first)) * 12 + F.month(month) - F.month(first)).cast("long")


def to_utc(wall: Column, zone: str) -> Column:
    """UTC wall time of a local wall time (both without zone).

    A local time that a spring change skips is read with the offset before the change; one
    that an autumn change repeats is read with the offset after it.
    """
    first = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    moment = first
    for shift in ("INTERVAL 30 MINUTES", "INTERVAL 60 MINUTES"):  # the sizes a clock goes back by
        second = first + F.expr(shift)
        moment = F.when(F.convert_timezone(F.lit("UTC"), F.lit(zone), second) == wall, second).otherwise(moment)
    return moment


def iso_parts(ts: Column) -> Sequence[Column]:
    return [
        F.extract(F.lit("YEAROFWEEK"), ts).cast("long").alias("iso_year"),
        F.weekofyear(ts).cast("long").alias("iso_week"),
        F.extract(F.lit("DAYOFWEEK_ISO"), ts).cast("long").alias("iso_weekday"),
    ]


def islands(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Runs of consecutive days per key.

    Days are made distinct first, so a group is bounded by the days of the calendar.
    """
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy(day)
    marked = df.select(*keys, day).distinct().withColumn("_island", F.date_sub(day, F.row_number().over(order)))
    return marked.groupBy(*keys, "_island").agg(
        F.min(day).alias("island_start"), F.max(day).alias("island_end"), F.count(F.lit(1)).alias("days_count")
    ).drop("_island")
