"""The nine raw tables, derived from the TPC-H-like test tables (see FIXTURES.md, part B)."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.layer import Layer


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _moment(column: str) -> Column:
    return F.col(column).cast("timestamp")


def raw_tables(spark: SparkSession, folder: str) -> Layer:
    """All nine raw tables. Payments and reviews carry ``arrival``, their row order."""

    @cache
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    def located(name: str, nation: str) -> DataFrame:
        places = table("nation").join(table("region"), F.expr("n_regionkey = r_regionkey"))
        return table(name).join(places, F.col(nation) == F.col("n_nationkey"))

    return Layer(
        {
            "customers": lambda: _customers(located("customer", "c_nationkey")),
            "sellers": lambda: _sellers(located("supplier", "s_nationkey")),
            "geolocation": lambda: _geolocation(located("customer", "c_nationkey")),
            "categories": lambda: _categories(table("part")),
            "products": lambda: _products(table("part")),
            "orders": lambda: _orders(table("orders")),
            "order_items": lambda: _order_items(table("lineitem")),
            "payments": lambda: payments(table("events")),
            "reviews": lambda: reviews(table("events")),
        }
    )


def with_gaps(raw: Layer) -> Layer:
    """The raw tables with five unknown zip prefixes and one untranslated category.

    Referential checks and enforcement find something in these tables only.
    """
    zip_code = F.col("geolocation_zip_code_prefix").cast("int")
    return raw.replacing(
        {
            "geolocation": lambda: raw["geolocation"].where(zip_code < 20),
            "categories": lambda: raw["categories"].where("product_category_name <> 'STANDARD'"),
        }
    )


def repeated_orders(orders: DataFrame) -> DataFrame:
    """Every order whose number divides by 3 a second time, with a later status."""
    again = orders.where("cast(order_id as bigint) % 3 = 0").withColumn("order_status", F.lit("Z"))
    return orders.unionByName(again)


# Key and changed attribute of tables whose entities are repeated for a test.
REPEATS = {
    "customers": ("customer_id", "customer_city"),
    "sellers": ("seller_id", "seller_city"),
    "products": ("product_id", "product_photos_qty"),
}


def repeated(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Every row whose key divides by 3 twice more: as it is, and with a smaller attribute."""
    again = df.where(F.col(key).cast("bigint") % 3 == 0)
    smaller = F.lit("A") if dict(df.dtypes)[attribute] == "string" else F.col(attribute) - 1
    return df.unionByName(again).unionByName(again.withColumn(attribute, smaller))


def unreadable_items(items: DataFrame) -> DataFrame:
    """Item prices as text that is a number, a word, or empty."""
    price = (
        F.when(F.col("order_item_id") == "3", "n/a")
        .when(F.col("order_item_id") == "5", "")
        .otherwise(F.col("price").cast("string"))
    )
    return items.withColumn("price", price)


def _customers(located: DataFrame) -> DataFrame:
    return located.select(
        _text("c_custkey").alias("customer_id"),
        # Two customer keys per person.
        F.expr("concat('person-', c_custkey div 2)").alias("customer_unique_id"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
        _text("c_nationkey").alias("customer_zip_code_prefix"),
    )


def _sellers(located: DataFrame) -> DataFrame:
    return located.select(
        _text("s_suppkey").alias("seller_id"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
        _text("s_nationkey").alias("seller_zip_code_prefix"),
    )


def _geolocation(located: DataFrame) -> DataFrame:
    return located.select(
        _text("c_nationkey").alias("geolocation_zip_code_prefix"),
        F.col("n_name").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
        F.col("c_acctbal").alias("geolocation_lat"),
        F.col("c_custkey").cast("double").alias("geolocation_lng"),
    )


def _categories(part: DataFrame) -> DataFrame:
    names = part.select(F.col("p_type").alias("product_category_name")).distinct()
    english = F.lower("product_category_name")
    return names.withColumn("product_category_name_english", english)


def _products(part: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("double")
    return part.select(
        _text("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        F.col("p_size").alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size + 1).alias("product_height_cm"),
        (size + 2).alias("product_width_cm"),
    )


def _orders(orders: DataFrame) -> DataFrame:
    placed = _moment("o_orderdate")
    # Handed over after 2 to 6 days, delivered 1 to 40 days later; every 13th is under way.
    handed_over = F.expr("cast(2 + o_orderkey % 5 as int)")
    travelled = F.expr("cast(1 + (o_orderkey * 7 + o_custkey) % 40 as int)")
    carrier = placed + F.make_dt_interval(days=handed_over)
    delivered = placed + F.make_dt_interval(days=handed_over + travelled)
    return orders.select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        (placed + F.expr("INTERVAL 1 DAY")).alias("order_approved_at"),
        carrier.alias("order_delivered_carrier_date"),
        F.when(F.expr("o_orderkey % 13 <> 0"), delivered).alias("order_delivered_customer_date"),
        (placed + F.expr("INTERVAL 30 DAY")).alias("order_estimated_delivery_date"),
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    """Line numbers repeat within an order of the test tables, and so do item numbers."""
    return lineitem.select(
        _text("l_orderkey").alias("order_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        _moment("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("double").alias("freight_value"),
        _text("l_linenumber").alias("order_item_id"),
    )


def _prop(name: str) -> Column:
    return F.get_json_object("props", f"$.{name}").try_cast("int")


def payments(events: DataFrame, without_order: Column | None = None) -> DataFrame:
    """Payments from events; rows where ``without_order`` holds get a NULL order."""
    order = F.expr("cast(event_id div 4 as string)")
    return events.select(
        _unless(without_order, order).alias("order_id"),
        F.expr("cast(1 + user_id % 3 as string)").alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        _prop("k").alias("payment_installments"),
        F.col("value").alias("payment_value"),
        F.col("event_id").alias("arrival"),
    )


def reviews(events: DataFrame, without_order: Column | None = None) -> DataFrame:
    """Reviews from events; rows where ``without_order`` holds get a NULL order."""
    order = F.expr("cast(event_id div 6 as string)")
    return events.select(
        F.expr("cast(event_id div 2 as string)").alias("review_id"),
        _unless(without_order, order).alias("order_id"),
        (1 + _prop("k") % 5).alias("review_score"),
        F.concat(F.lit("rated "), F.get_json_object("props", "$.k")).alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").cast("date").alias("review_creation_date"),
        _moment("ts").alias("review_answer_timestamp"),
        F.col("event_id").alias("arrival"),
    )


def _unless(condition: Column | None, value: Column) -> Column:
    return value if condition is None else F.when(~condition, value)
