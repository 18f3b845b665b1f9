"""The job on a small shop: clean, enforce, model, check, measure."""

import datetime as dt

import pytest
import shop
from conftest import rows
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators import constraints
from starmill.plans import clean as cleaning
from starmill.plans import integrity
from starmill.plans.model import Warehouse


@pytest.fixture(scope="module")
def clean(spark):
    return cleaning.clean(shop.raw(spark))


@pytest.fixture(scope="module")
def warehouse(clean):
    return Warehouse(clean, closed="right")


def test_products_need_a_translated_category(clean):
    assert rows(clean["products"], "product_id", "product_category_name_english") == [
        ("p1", "toys"), ("p2", "books"),
    ]


def test_unreadable_product_numbers_are_null(clean):
    book = clean["products"].where("product_id = 'p2'").first()
    assert book.product_name_lenght is None and book.product_description_lenght is None
    assert book.product_weight_g is None and book.product_length_cm == 20.0


def test_geolocation_averages_readable_coordinates(clean):
    assert rows(clean["geolocation"]) == [
        ("01", "porto", "N", 42.0, -8.0), ("02", "faro", "S", 37.0, -7.9),
    ]


def test_geolocation_place_is_a_pair_that_occurs(spark):
    data = [("1", None, None, "a", "Y"), ("1", None, None, "b", "X"), ("1", None, None, None, "A")]
    schema = ", ".join(f"{c} string" for c in shop.COLUMNS["geolocation"].split())
    rolled = cleaning.roll_up_geolocation(spark.createDataFrame(data, schema))
    assert rows(rolled, "geolocation_city", "geolocation_state") == [("a", "Y")]


def test_reviews_prefer_a_row_with_an_order(clean):
    assert rows(clean["reviews"].where("review_id is not null"), "review_id", "order_id") == [
        ("r1", "o1"), ("r2", "o1"), ("r3", "o2"), ("r4", "o4"),
    ]


def test_enforcement(clean):
    kept = integrity.enforce_integrity(clean)
    assert rows(kept["customers"], "customer_id") == [("c1",), ("c2",), ("c3",)]
    assert rows(kept["sellers"], "seller_id") == [("s1",), (None,)]
    assert rows(kept["orders"], "order_id") == [("o1",), ("o2",), ("o3",), ("o5",)]
    assert rows(kept["order_items"].where("order_id <> 'o1'"), "order_id", "order_item_id") == [
        ("o2", "1"), ("o3", "1"),
    ]
    assert rows(kept["payments"], "order_id", "payment_sequential") == [
        ("o1", "1"), ("o1", "2"), ("o2", "1"), ("o3", "1"),
    ]
    again = integrity.integrity_report(kept).where("check <> 'orders_without_items'")
    assert {r.orphans for r in again.collect()} == {0}


def test_report(clean):
    assert rows(integrity.integrity_report(clean)) == [
        ("orders_without_items", 1),
        ("orphan_customer_zips", 1),
        ("orphan_products", 1),
        ("orphan_sellers", 0),
    ]
    assert rows(integrity.integrity_findings(clean)) == [
        ("orders_without_items", "o5"),
        ("orphan_customer_zips", "1"),
        ("orphan_products", "p3"),
    ]


def test_dimensions_drop_null_ids(warehouse):
    assert rows(warehouse.table("dim_sellers"), "seller_sk", "seller_id") == [(1, "s1")]
    assert rows(warehouse.table("dim_reviews"), "review_sk", "review_id") == [
        (1, "r1"), (2, "r2"), (3, "r3"),
    ]


def test_order_fact(warehouse):
    fact = warehouse.table("fact_orderlifecycle")
    # 11 items with two reviews each, one item with one review, one without any.
    assert fact.count() == 24
    assert rows(fact.where("order_id = 'o2'"), "review_sk", "price", "total_price") == [
        (3, 20.0, None)
    ]
    assert rows(fact.where("order_id = 'o3'"), "review_sk", "total_price") == [(None, 32.0)]
    # The spine starts a day after the first purchase; later days than the last have no key.
    days = fact.where("order_id = 'o2'").first()
    assert (days.order_purchase_date_sk, days.delivered_customer_date_sk) == (2, None)
    assert days.order_approved_date_sk is None
    assert fact.where("order_id = 'o1'").first().order_purchase_date_sk is None
    assert days.shipping_limit_date == dt.datetime(2018, 1, 6, 12)


def item_order(warehouse):
    fact = warehouse.table("fact_orderlifecycle").where("order_id = 'o1'").orderBy("order_sk")
    return [r.order_item_id for r in fact.collect()][::2]


def test_fact_is_numbered_by_number_or_by_text(clean, warehouse):
    assert item_order(warehouse) == list(range(1, 12))
    by_text = Warehouse(clean, text_item_order=True)
    assert item_order(by_text) == [1, 10, 11, 2, 3, 4, 5, 6, 7, 8, 9]


def test_inclusive_spine_and_more_date_columns(clean):
    inclusive = Warehouse(clean, date_columns=["order_estimated_delivery_date"])
    first = inclusive.table("fact_orderlifecycle").where("order_id = 'o1'").first()
    assert (first.order_purchase_date_sk, first.estimated_delivery_date_sk) == (1, 5)
    assert inclusive.table("dim_date").count() == 20


def test_payment_fact(warehouse):
    payments = warehouse.table("fact_orderpayments")
    assert rows(payments, "payment_sk", "order_id", "payment_sequential", "payment_value") == [
        (1, "o1", 1, 100.0), (2, "o1", 2, 26.5), (3, "o2", 1, 41.0), (4, "o3", 1, 32.0),
    ]
    assert payments.where("order_id = 'o3'").first().payment_installments is None


def test_repeated_order_ids_do_not_multiply(spark):
    orders = [o for o in shop.ROWS["orders"] if o[0] == "o1"] * 3
    items = [i for i in shop.ROWS["order_items"] if i[0] == "o1" and i[1] in ("1", "2")]
    raw = shop.raw(spark, orders=orders, order_items=items)
    built = Warehouse(cleaning.clean(raw))
    assert built.table("fact_orderlifecycle").count() == 4
    assert built.table("fact_orderpayments").count() == 2


def test_enforced_and_clean_tables_give_the_same_warehouse(clean, warehouse):
    from_enforced = Warehouse(integrity.enforce_integrity(clean), closed="right")
    for name in schemas.TABLES:
        assert rows(from_enforced.table(name)) == rows(warehouse.table(name)), name


def test_key_methods_agree(clean, warehouse):
    at_once = Warehouse(clean, closed="right", key_method="global")
    for name in schemas.TABLES:
        assert rows(at_once.table(name)) == rows(warehouse.table(name)), name
    with pytest.raises(ValueError):
        Warehouse(clean, key_method="natural").table("fact_orderpayments")


def test_input_order_does_not_matter(spark, warehouse):
    shuffled = {
        name: df.orderBy(F.rand(7)).repartition(5) for name, df in shop.raw(spark).items()
    }
    again = Warehouse(cleaning.clean(shuffled), closed="right")
    for name in schemas.TABLES:
        assert rows(again.table(name)) == rows(warehouse.table(name)), name


def test_job_without_orders(spark):
    empty = Warehouse(cleaning.clean(shop.raw(spark, orders=[], order_items=[])))
    sizes = {t: empty.table(t).count() for t in ("dim_date", "fact_orderlifecycle", "dim_products")}
    assert list(sizes.values()) == [0, 0, 2]


def test_tables_conform(warehouse):
    for name in schemas.TABLES:
        conformed = schemas.conform(warehouse.table(name), name)
        assert schemas.schema_mismatches(conformed, name) == []
        wide = schemas.conform(warehouse.table(name), name, wide_keys=True)
        assert schemas.schema_mismatches(wide, name, wide_keys=True) == []


def test_mismatches_are_named(spark):
    df = spark.createDataFrame([(1, "x", 2)], "date_sk bigint, date string, extra int")
    found = schemas.schema_mismatches(df, "dim_date")
    assert "undeclared extra" in found and "missing quarter" in found
    assert "date is string, declared date" in found


def test_key_beyond_int_stops_the_load(warehouse):
    big = warehouse.table("dim_sellers").withColumn("seller_sk", F.lit(2**31))
    with pytest.raises(Exception, match="wide_keys"):
        schemas.conform(big, "dim_sellers").collect()
    assert schemas.conform(big, "dim_sellers", wide_keys=True).first().seller_sk == 2**31


def test_built_warehouse_has_no_violations(warehouse):
    tables = warehouse.all_tables()
    for check in (
        constraints.check_primary_keys,
        constraints.check_unique_keys,
        constraints.check_foreign_keys,
    ):
        assert {r.violations for r in check(tables).collect()} == {0}
    assert rows(constraints.repeated_keys(tables)) == []
    assert rows(constraints.dangling_keys(tables)) == []


def test_violations_are_found(warehouse):
    sellers = warehouse.table("dim_sellers")
    nameless = sellers.withColumns({"seller_sk": F.lit(None), "seller_id": F.lit(None)})
    broken = {
        **warehouse.all_tables(),
        "dim_sellers": sellers.union(sellers).union(nameless).union(nameless),
        "dim_products": warehouse.table("dim_products").where("product_sk <> 1"),
    }
    primary = {r.table_name: r.violations for r in constraints.check_primary_keys(broken).collect()}
    assert primary["dim_sellers"] == 3 and primary["dim_customers"] == 0
    unique = {r.table_name: r.violations for r in constraints.check_unique_keys(broken).collect()}
    assert unique["dim_sellers"] == 1
    foreign = {
        (r.table_name, r.key_name): r.violations
        for r in constraints.check_foreign_keys(broken).collect()
    }
    assert len(foreign) == 12 and foreign[("fact_orderlifecycle", "product_sk")] == 23
    assert sum(foreign.values()) == 23
    assert rows(constraints.dangling_keys(broken)) == [
        ("fact_orderlifecycle", "product_sk", "dim_products", 1, 23)
    ]
    assert rows(constraints.repeated_keys(broken)) == [
        ("dim_sellers", "seller_id", "s1", 2),
        ("dim_sellers", "seller_sk", "1", 2),
        ("dim_sellers", "seller_sk", None, 2),
    ]


def test_references_are_checked_before_facts_are_numbered(spark, clean, monkeypatch):
    built = Warehouse(clean, closed="right")
    monkeypatch.setattr(Warehouse, "_numbered", None)
    found = rows(constraints.check_foreign_keys(built.referring_rows()))
    assert len(found) == len(schemas.FOREIGN_KEY) and {r[2] for r in found} == {0}


def test_segments_stage_in_the_folder_they_are_given(spark, clean):
    from starmill.plans import measures

    built = Warehouse(clean, key_method="natural")
    segments = measures.customer_segments(built.payment_rows, built.dim_customers, folder=built.folder)
    assert segments.count() == 2
    assert all(built.folder in f for f in segments.inputFiles() if "spend" in f)
    built.release()
    with pytest.raises(Exception, match="(?i)not.?exist"):
        segments.collect()
