"""Dashboard filters: a date range and multi-select lists, all optional."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.dates import year_month

# Tables written by the pipeline are partitioned by this month column.
MONTH_PARTITION = "order_ym"


@dataclass(frozen=True)
class Filters:
    """``from_date`` and ``to_date`` are inclusive; an empty list of values filters nothing."""

    from_date: date | None = None
    to_date: date | None = None
    values: dict[str, list] = field(default_factory=dict)

    def dates(self, df: DataFrame, column: str = "order_date") -> DataFrame:
        """Apply the date range. The month partition is filtered too, as Spark cannot derive it from the day."""
        by_month = MONTH_PARTITION in df.columns and column == "order_date"
        for day, compare in ((self.from_date, "__ge__"), (self.to_date, "__le__")):
            if day is None:
                continue
            df = df.filter(getattr(F.col(column), compare)(F.lit(day)))
            if by_month:
                df = df.filter(getattr(F.col(MONTH_PARTITION), compare)(year_month(F.lit(day))))
        return df

    def choices(self, df: DataFrame, *columns: str) -> DataFrame:
        for column in columns:
            wanted = self.values.get(column)
            if wanted:
                df = df.filter(F.col(column).isin(*wanted))
        return df


NO_FILTERS = Filters()


def relative_range(name: str, as_of: date) -> Filters:
    """The ranges a dashboard opens with: "Last week" and "Last month", up to and including ``as_of``."""
    if name == "Last week":
        return Filters(as_of - timedelta(days=7), as_of)
    if name == "Last month":
        year, month = (as_of.year, as_of.month - 1) if as_of.month > 1 else (as_of.year - 1, 12)
        last = (date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)).day
        return Filters(date(year, month, min(as_of.day, last)), as_of)
    raise ValueError(f"unknown relative range: {name}")


# The filters of each dashboard and what they open with. The channel filter names a column that
# the daily mart does not have; it selects nothing and filters nothing.
DASHBOARD_FILTERS: dict[str, dict[str, str | None]] = {
    "executive": {"order_date": "Last week", "channel": None},
    "units": {"state_name": None, "order_date": "Last month"},
    "products": {"product_name": None, "order_date": "Last month"},
    "orders": {"order_date": "Last week", "order_type": None, "order_status": None},
}


def default_filters(dashboard: str, as_of: date) -> Filters:
    """The filters a dashboard opens with: its date range, every choice empty."""
    defaults = DASHBOARD_FILTERS[dashboard]
    opened = relative_range(defaults["order_date"], as_of)
    return Filters(opened.from_date, opened.to_date, {column: [] for column in defaults if column != "order_date"})
