"""Dashboard measures on a small shop, and exact quantiles against brute force."""

import datetime as dt

import numpy as np
import pytest
import shop
from conftest import rows

from starmill.operators.quantiles import exact_quantiles
from starmill.plans import clean as cleaning
from starmill.plans import measures
from starmill.plans.model import Warehouse


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse(cleaning.clean(shop.raw(spark)))


@pytest.fixture(scope="module")
def fact(warehouse):
    return warehouse.table("fact_orderlifecycle")


def test_sales_count_each_item_once(fact):
    assert rows(measures.total_sales(fact)) == [(11 * 11.5 + 32.0,)]
    assert rows(measures.total_sales(fact, ["delivered"])) == [(11 * 11.5,)]
    assert rows(measures.order_count(fact)) == [(3,)]


def test_rows_before_reviews_give_the_same_measures(warehouse, fact):
    assert warehouse.sales_rows.count() < fact.count()
    for measure in (
        measures.total_sales, measures.order_count, measures.on_time_delivery,
        measures.sales_by_month, measures.lifecycle_by_status,
    ):
        assert rows(measure(warehouse.sales_rows)) == rows(measure(fact))


def test_items_with_repeated_or_unreadable_numbers_count(spark):
    """Two unreadable numbers, and two products under number 1: 56.0 in all."""
    items = [
        ("o1", "a", "p1", "s1", "2018-01-02 12:00:00", "10.0", "1.0"),
        ("o1", "b", "p1", "s1", "2018-01-02 12:00:00", "12.0", "1.0"),
        ("o3", "1", "p1", "s1", "2018-01-04 12:00:00", "14.0", "1.0"),
        ("o3", "1", "p2", "s1", "2018-01-04 12:00:00", "16.0", "1.0"),
    ]
    built = Warehouse(cleaning.clean(shop.raw(spark, order_items=items)))
    whole = built.table("fact_orderlifecycle")
    assert whole.count() == 6  # order o1 has two reviews
    assert rows(measures.total_sales(built.sales_rows)) == [(56.0,)]
    assert rows(measures.total_sales(whole)) == [(56.0,)]
    by_category = measures.sales_by_category(whole, built.table("dim_products"))
    assert rows(by_category) == [("books", 17.0, 1), ("toys", 39.0, 2)]


def test_on_time(fact):
    assert rows(measures.on_time_delivery(fact)) == [(1, 2, 50.0)]
    assert rows(measures.on_time_delivery(fact, ["canceled"])) == [(0, 0, None)]


def test_payment_mix(warehouse):
    mix = measures.payment_mix(warehouse.table("fact_orderpayments"))
    assert rows(mix.selectExpr("payment_type", "payments", "round(value_pct, 3)")) == [
        ("card", 2, round(100 * 132 / 199.5, 3)),
        ("slip", 1, round(100 * 41 / 199.5, 3)),
        ("voucher", 1, round(100 * 26.5 / 199.5, 3)),
    ]


def test_month_over_month_fills_gaps(spark):
    paid = spark.createDataFrame(
        [("2018-01-05", 10.0), ("2018-01-09", 10.0), ("2018-02-01", 30.0), ("2018-04-01", 5.0)],
        "t string, payment_value double",
    ).selectExpr("cast(t as timestamp) payment_timestamp", "payment_value")
    assert rows(measures.payments_month_over_month(paid)) == [
        (dt.date(2018, 1, 1), 20.0, None, None),
        (dt.date(2018, 2, 1), 30.0, 20.0, 50.0),
        (dt.date(2018, 3, 1), 0.0, 30.0, -100.0),
        (dt.date(2018, 4, 1), 5.0, 0.0, None),
    ]
    assert rows(measures.payments_month_over_month(paid.limit(0))) == []


def test_segments(warehouse):
    payments, customers = warehouse.table("fact_orderpayments"), warehouse.table("dim_customers")
    # u1 paid as two customers.
    assert rows(measures.customer_spend(payments, customers)) == [("u1", 158.5), ("u2", 41.0)]
    assert rows(measures.customer_segments(payments, customers)) == [
        ("u1", 158.5, "High"), ("u2", 41.0, "Low"),
    ]
    assert rows(measures.customer_segments(payments, customers, (41.0, 500.0))) == [
        ("u1", 158.5, "Medium"), ("u2", 41.0, "Medium"),
    ]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 100, 301])
def test_quantiles_against_brute_force(spark, size):
    generator = np.random.default_rng(size)
    values = np.round(generator.gamma(2.0, 50.0, size), 1)
    values[: size // 3] = 7.0  # a third of all rows share one value
    df = spark.createDataFrame(
        [(float(v), str(i)) for i, v in enumerate(values)] + [(None, "x")], "v double, id string"
    )
    found = exact_quantiles(df, "v", {"a": (1, 3), "b": (2, 3), "c": (1, 2)}, "id").first()
    expected = np.quantile(values, [1 / 3, 2 / 3, 1 / 2])
    assert tuple(found) == pytest.approx(tuple(expected), abs=1e-9)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double, id string")
    assert rows(exact_quantiles(df, "v", {"a": (1, 3)}, "id")) == [(None,)]


def test_nps(warehouse):
    assert rows(measures.review_nps(warehouse.table("dim_reviews"))) == [(1, 1, 1, 3, 0.0)]


def test_sales_groups(warehouse, fact):
    by_category = measures.sales_by_category(fact, warehouse.table("dim_products"))
    assert rows(by_category) == [("books", None, 1), ("toys", 158.5, 2)]
    by_state = measures.sales_by_state(fact, warehouse.table("dim_customers"))
    assert rows(by_state) == [("N", 158.5, 2), ("S", None, 1)]
    assert rows(measures.sales_by_month(fact)) == [(dt.date(2018, 1, 1), 158.5, 3)]


def test_lifecycle(fact):
    by_status = {r.order_status: r for r in measures.lifecycle_by_status(fact).collect()}
    assert by_status["delivered"].orders == 2
    assert by_status["delivered"].days_to_approval == 0.0
    assert by_status["delivered"].days_to_customer == 3.0
    assert by_status["delivered"].days_past_estimate == -0.5
    assert by_status["canceled"].days_to_customer is None


def test_order_detail(spark, warehouse, fact):
    dimensions = warehouse.all_tables()
    detail = measures.order_detail(fact, dimensions, ["o2"])
    assert rows(detail, "order_id", "customer_city", "product_category_english_name",
                "seller_city", "review_score", "purchase_month") == [
        ("o2", "faro", "books", "porto", 4, 1)
    ]
    wanted = spark.createDataFrame([("o2",), ("o3",), ("o3",)], "order_id string")
    assert measures.order_detail(fact, dimensions, wanted).count() == 2
    assert measures.order_detail(fact, dimensions).count() == fact.count()
    shared = ["order_id", "order_item_id", "customer_id", "customer_city", "product_id",
              "seller_city", "review_id", "review_score", "purchase_year", "purchase_month"]
    for chosen in (None, ["o2"], wanted):
        assert rows(warehouse.order_detail(chosen), *shared) == rows(
            measures.order_detail(fact, dimensions, chosen), *shared
        )
    paid = measures.order_payment_detail(
        warehouse.table("fact_orderpayments"), dimensions["dim_customers"], wanted
    )
    assert rows(paid, "order_id", "customer_unique_id") == [("o2", "u2"), ("o3", "u1")]
