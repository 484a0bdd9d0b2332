"""Exact arithmetic on money and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(20,2)"


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def total(amount: Column) -> Column:
    return F.round(F.sum(amount), 2).cast(TOTAL)


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """numerator / denominator rounded half up, null when the denominator is zero; exact for counts and money."""
    return F.round(numerator.cast("decimal(24,2)") / F.nullif(denominator, F.lit(0)), scale)


def mean(amount: Column) -> Column:
    """Average over the non-null values: sum over count, so that it stays exact and merges across partitions."""
    return ratio(F.sum(amount), F.count(amount)).cast(TOTAL)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * 100, whole).cast("double")
