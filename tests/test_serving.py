from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.functions.filters import DASHBOARD_FILTERS, Filters, default_filters, relative_range
from tillflow.operators import serving

DAILY = (
    "order_date date, day_of_week_name string, is_weekend boolean, total_orders long, online_orders long, "
    "physical_orders long, canceled_orders long, total_revenue decimal(20,2), online_revenue decimal(20,2), "
    "physical_revenue decimal(20,2), avg_order_value decimal(20,2), online_pct double, cancellation_rate double"
)


@pytest.fixture
def daily(spark):
    def row(day, name, weekend, orders, canceled, revenue):
        money = Decimal(revenue)
        return (day, name, weekend, orders, orders - 1, 1, canceled, money, money, Decimal(0), money, 1.0, 2.0)

    return spark.createDataFrame(
        [
            row(date(2026, 1, 3), "Saturday", True, 3, 1, "10.00"),
            row(date(2026, 1, 5), "Monday", False, 1, 0, "1.00"),
            row(date(2026, 1, 6), "Tuesday", False, 3, 1, "0.05"),
            row(date(2026, 1, 12), "Monday", False, 2, 0, "4.00"),
        ],
        DAILY,
    )


def test_ratios_are_ratios_of_sums(daily):
    assert rows(serving.exec_total_revenue(daily)) == [(Decimal("15.05"),)]
    assert float(serving.exec_avg_order_value(daily).first()[0]) == 1.67
    assert rows(serving.exec_cancellation_rate(daily)) == [(22.22,)]


def test_no_orders_gives_null_not_an_error(daily):
    none = Filters(date(2030, 1, 1))
    assert rows(serving.exec_avg_order_value(daily, none)) == [(None,)]
    assert rows(serving.exec_cancellation_rate(daily, none)) == [(None,)]


def test_channels_weekdays_and_weekend(daily):
    assert rows(serving.exec_orders_by_channel(daily)) == [("Online", 5), ("Physical", 4)]
    assert rows(serving.exec_revenue_by_weekday(daily), "day_of_week_name", "total_orders") == [
        ("Monday", 3),
        ("Tuesday", 3),
        ("Saturday", 3),
    ]
    assert dict(rows(serving.exec_weekend_vs_weekday(daily))) == {"Weekend": Decimal("10.00"), "Weekday": Decimal("5.05")}


def test_date_filter_is_inclusive_on_both_ends(daily):
    trend = serving.exec_revenue_trend(daily, Filters(date(2026, 1, 5), date(2026, 1, 6)))
    assert [r.order_date.day for r in trend.collect()] == [5, 6]
    assert [r.order_date.day for r in serving.exec_revenue_trend(daily, Filters(date(2026, 1, 6))).collect()] == [6, 12]


@pytest.mark.parametrize(
    ("name", "as_of", "first"),
    [
        ("Last week", date(2026, 1, 3), date(2025, 12, 27)),
        ("Last month", date(2026, 1, 15), date(2025, 12, 15)),
        ("Last month", date(2026, 3, 31), date(2026, 2, 28)),
        ("Last month", date(2024, 3, 30), date(2024, 2, 29)),
    ],
)
def test_relative_ranges(name, as_of, first):
    assert relative_range(name, as_of) == Filters(first, as_of)


def test_empty_choice_filters_nothing(spark):
    frame = spark.createDataFrame([("A",), ("B",), (None,)], "state_name string")
    assert Filters(values={"state_name": []}).choices(frame, "state_name").count() == 3
    assert Filters(values={"state_name": ["A", "B"]}).choices(frame, "state_name").count() == 2


def sales(spark, values, status="Finalizado"):
    cells = [(f"O{i}", date(2026, 1, 1), "ONLINE", status, 1, Decimal(v), None) for i, v in enumerate(values)]
    return spark.createDataFrame(
        cells,
        "order_id string, order_date date, order_type string, order_status string, total_items long, "
        "order_value decimal(10,2), delivery_fee decimal(10,2)",
    )


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        (["0.00", "10.00"], {1: 1, 10: 1}),
        (["0.00", "1.00", "9.99", "10.00"], {1: 1, 2: 1, 10: 2}),
        (["5.00", "5.00"], {1: 2}),
        ([], {}),
    ],
)
def test_histogram(spark, values, expected):
    found = serving.orders_value_histogram(sales(spark, values))
    assert dict(rows(found, "bin", "order_count")) == expected


def test_histogram_leaves_canceled_orders_out(spark):
    frame = sales(spark, ["1.00", "2.00"]).unionByName(sales(spark, ["100.00"], "Cancelado"))
    assert serving.orders_value_histogram(frame).agg(F.sum("order_count")).first()[0] == 2


def test_top_orders_break_ties_by_id(spark):
    found = serving.orders_top_orders(sales(spark, ["1.00"] * 30))
    ids = [r.order_id for r in found.collect()]
    assert ids == sorted(f"O{i}" for i in range(30))[:20]


def test_chart_rows(spark):
    frame = spark.createDataFrame([(f"g{i % 60:02d}", float(i)) for i in range(120)], "g string, v double")
    shown = serving.chart_rows(frame, ["g"], ["v"])
    assert shown.count() == 50
    assert rows(shown)[0] == ("g59", 119.0)
    assert rows(serving.chart_rows(frame, [], ["v"])) == [(119.0,)]
    assert serving.chart_rows(frame, ["g"], ["v"], "pie").count() == 60


def test_units_of_one_name_merge_in_the_star_join(spark):
    facts = sales(spark, ["1.00", "2.00", "4.00"]).withColumn("date_key", F.lit("20260101")).withColumn(
        "unit_key", F.substring("order_id", 2, 1).cast("long")
    )
    days = spark.createDataFrame([("20260101", "2026-01")], "date_key string, year_month string")
    units = spark.createDataFrame([(0, "S", "U"), (1, "S", "U"), (2, "S", "V")], "unit_key long, state_name string, unit_name string")
    for unique in (True, False):
        found = serving.star_join_top10(facts, days, units, unique)
        assert rows(found, "unit_name", "total_orders", "avg_order_value") == [("V", 1, Decimal("4.00")), ("U", 2, Decimal("1.50"))]


def test_dashboards_open_with_their_defaults(daily):
    assert sum(len(f) for f in DASHBOARD_FILTERS.values()) == 9
    opened = default_filters("executive", date(2026, 1, 12))
    assert [r.order_date.day for r in serving.exec_revenue_trend(daily, opened).collect()] == [5, 6, 12]
    assert default_filters("orders", date(2026, 1, 8)).values == {"order_type": [], "order_status": []}
