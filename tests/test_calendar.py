"""Date bounds, spine, attributes and the two forms of date keys."""

import datetime as dt

import pytest
from conftest import rows

from starmill.functions import calendar


def bounds(spark, lo, hi):
    return spark.createDataFrame([(lo, hi)], "lo string, hi string").selectExpr(
        "cast(lo as date) lo", "cast(hi as date) hi"
    )


def days(df):
    return [(r.date_sk, str(r.date)) for r in df.orderBy("date_sk").collect()]


def test_spine(spark):
    b = bounds(spark, "2018-01-01", "2018-01-04")
    assert days(calendar.date_spine(b, "right")) == [
        (1, "2018-01-02"), (2, "2018-01-03"), (3, "2018-01-04"),
    ]
    assert len(days(calendar.date_spine(b))) == 4


def test_spine_of_one_day(spark):
    b = bounds(spark, "2018-01-01", "2018-01-01")
    assert days(calendar.date_spine(b, "right")) == []
    assert days(calendar.date_spine(b, "both")) == [(1, "2018-01-01")]


def test_spine_without_orders(spark):
    b = bounds(spark, None, None)
    assert days(calendar.date_spine(b, "right")) == days(calendar.date_spine(b)) == []


def test_bounds(spark):
    orders = spark.createDataFrame(
        [("2018-01-03 10:00:00", "2018-02-01 00:00:00"), ("2018-01-02 23:59:59", None)],
        "order_purchase_timestamp string, order_estimated_delivery_date string",
    )
    assert rows(calendar.date_bounds(orders)) == [(dt.date(2018, 1, 2), dt.date(2018, 1, 3))]
    wider = calendar.date_bounds(orders, ["order_estimated_delivery_date"])
    assert rows(wider) == [(dt.date(2018, 1, 2), dt.date(2018, 2, 1))]
    assert rows(calendar.date_bounds(orders.limit(0))) == [(None, None)]


def test_day_of_week_starts_on_sunday(spark):
    df = spark.createDataFrame([("2018-01-07",), ("2018-01-06",)], "d string").selectExpr(
        "cast(d as date) date"
    )
    found = calendar.date_attributes(df).orderBy("date").collect()
    assert [r.day_of_week for r in found] == [7, 1]
    assert (found[1].day, found[1].month, found[1].year, found[1].quarter) == (7, 1, 2018, 1)


@pytest.mark.parametrize("closed", ["both", "right"])
@pytest.mark.parametrize("hi", ["2018-01-05", "2018-01-01", None])
def test_key_by_arithmetic_equals_key_by_join(spark, closed, hi):
    b = bounds(spark, "2018-01-01" if hi else None, hi)
    data = ["2017-12-31", "2018-01-01", "2018-01-02", "2018-01-05", "2018-01-06", None]
    df = spark.createDataFrame([(d,) for d in data], "d string").selectExpr("cast(d as date) d")
    roles = {"first_sk": "d", "second_sk": "d"}
    computed = calendar.add_date_keys(df, roles, b, closed)
    joined = calendar.join_date_keys(df, roles, calendar.date_spine(b, closed))
    order = ["d", "first_sk", "second_sk"]
    assert rows(computed, *order) == rows(joined, *order)


def test_event_dates_keep_the_timestamp(spark):
    df = spark.createDataFrame([("2018-01-01 23:30:00",), ("",)], "shipping_limit_date string")
    dated = calendar.event_dates(df)
    assert rows(dated) == [("", None), ("2018-01-01 23:30:00", dt.date(2018, 1, 1))]


def test_day_follows_the_session_zone(spark, settings):
    settings(spark__sql__session__timeZone="America/Sao_Paulo")
    orders = spark.createDataFrame([("2018-01-01 23:30:00",)], "order_purchase_timestamp string")
    assert rows(calendar.date_bounds(orders)) == [(dt.date(2018, 1, 1), dt.date(2018, 1, 1))]
