"""Dimension tables of the star schema."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions import dates

DEFAULT_FIRST_DAY = date(2025, 1, 1)
DEFAULT_LAST_DAY = date(2027, 12, 31)
OPEN_END = datetime(9999, 12, 31, 23, 59, 59)


def dim_date(spark: SparkSession, first: date = DEFAULT_FIRST_DAY, last: date = DEFAULT_LAST_DAY) -> DataFrame:
    """The days of a given range."""
    return _described(dates.days_between(spark, first, last, "d"))


def dim_date_of(orders: DataFrame) -> DataFrame:
    """The days of all years from the first to the last order."""
    ends = orders.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last")).filter("first IS NOT NULL")
    last = F.make_date(F.year("last"), F.lit(12), F.lit(31))
    return _described(ends.select(F.explode(F.sequence(F.trunc("first", "year"), last)).alias("d")))


def _described(days: DataFrame) -> DataFrame:
    day, weekday = F.col("d"), F.dayofweek("d")
    month_start = F.trunc(day, "MM")
    return days.select(
        dates.date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.year(day), F.lit("-Q"), F.quarter(day)).alias("year_quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        dates.year_month(day).alias("year_month"),
        dates.sunday_week(day).alias("week_of_year"),
        F.weekofyear(day).alias("iso_week"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week_num"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.date_format(day, "E").alias("day_of_week_abbrev"),
        F.dayofyear(day).alias("day_of_year"),
        weekday.isin(1, 7).alias("is_weekend"),
        weekday.between(2, 6).alias("is_weekday"),
        (F.datediff(day, month_start) + 1).alias("day_in_month"),
        F.last_day(day).alias("last_day_of_month"),
        month_start.alias("first_day_of_month"),
    )


def _version(as_of) -> list[Column]:
    """Validity columns: every row is current, from now on and without end."""
    start = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return [
        start.alias("_valid_from"),
        F.lit(OPEN_END.isoformat(sep=" ")).cast("timestamp").alias("_valid_to"),
        F.lit(True).alias("is_current"),
    ]


def dim_product(products: DataFrame, as_of=None) -> DataFrame:
    return products.select(F.col("product_id").alias("product_key"), "product_id", "product_name", *_version(as_of))


def dim_unit(units: DataFrame, as_of=None) -> DataFrame:
    geography = ("state_id", "state_name", "country_id", "country_name")
    return units.select(F.col("unit_id").alias("unit_key"), "unit_id", "unit_name", *geography, *_version(as_of))


def dim_geography(states: DataFrame, countries: DataFrame) -> DataFrame:
    return states.join(countries.select("country_id", "country_name"), "country_id").select(
        F.col("state_id").alias("geography_key"),
        "state_id",
        "state_name",
        "country_id",
        "country_name",
    )
