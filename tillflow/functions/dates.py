"""Calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def sunday_week(day: Column) -> Column:
    """Week of the year, 0 to 53, where a week starts on Sunday."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def weekday_position(name: Column) -> Column:
    """1 for Monday up to 7 for Sunday."""
    return F.array_position(F.array(*[F.lit(day) for day in WEEKDAYS]), name)


def days_between(spark, first: date, last: date, name: str):
    """One row per day from ``first`` to ``last``, both included."""
    span = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1, numPartitions=1).select(F.explode(span).alias(name))
