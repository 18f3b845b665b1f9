"""Raw layer to clean layer: required keys, one row per key, types, translation."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.casts import typed
from starmill.layer import Layer
from starmill.operators.dedup import keep_one, require
from starmill.operators.matching import lookup


Rule = Callable[..., DataFrame]


def as_is(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """In place of :func:`keep_one` for a table whose key is declared unique already."""
    return df


def clean_customers(
    customers: DataFrame, prefer: Sequence[str] = (), one: Rule = keep_one
) -> DataFrame:
    return one(require(customers, "customer_id"), ["customer_id"], prefer)


def type_orders(orders: DataFrame) -> DataFrame:
    return typed(
        orders,
        order_purchase_timestamp="timestamp",
        order_approved_at="timestamp",
        order_delivered_carrier_date="timestamp",
        order_delivered_customer_date="timestamp",
        order_estimated_delivery_date="timestamp",
    )


def clean_orders(
    orders: DataFrame, prefer: Sequence[str] = (), one: Rule = keep_one
) -> DataFrame:
    """Orders are reduced to one row per order_id: a repeat would multiply all its facts."""
    return one(type_orders(require(orders, "order_id", "customer_id")), ["order_id"], prefer)


def type_order_items(items: DataFrame) -> DataFrame:
    """The item number stays text: the order fact can be numbered by its text order."""
    return typed(items, price="double", freight_value="double", shipping_limit_date="timestamp")


def clean_order_items(items: DataFrame) -> DataFrame:
    return type_order_items(require(items, "order_id", "order_item_id"))


def clean_categories(
    categories: DataFrame, prefer: Sequence[str] = (), one: Rule = keep_one
) -> DataFrame:
    return one(categories, ["product_category_name"], prefer)


def type_products(products: DataFrame) -> DataFrame:
    return typed(
        products,
        product_name_lenght="int",
        product_description_lenght="int",
        product_photos_qty="int",
        product_weight_g="double",
        product_length_cm="double",
        product_height_cm="double",
        product_width_cm="double",
    )


def translate_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Add the English category. Products without a translated category are left out."""
    return lookup(products, "product_category_name", categories)


def clean_products(
    products: DataFrame,
    categories: DataFrame,
    prefer: Sequence[str] = (),
    one: Rule = keep_one,
) -> DataFrame:
    """``categories`` is the clean table."""
    unique = one(products, ["product_id"], prefer)
    return translate_products(type_products(unique), categories)


def clean_sellers(
    sellers: DataFrame, prefer: Sequence[str] = (), one: Rule = keep_one
) -> DataFrame:
    return one(sellers, ["seller_id"], prefer)


def roll_up_geolocation(geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix: a city and state that occur together, average coordinates."""
    place = F.struct(
        F.col("geolocation_city").isNull(),
        F.col("geolocation_state").isNull(),
        F.col("geolocation_city").alias("geolocation_city"),
        F.col("geolocation_state").alias("geolocation_state"),
    )
    return (
        typed(geolocation, geolocation_lat="double", geolocation_lng="double")
        .groupBy("geolocation_zip_code_prefix")
        .agg(
            F.min(place).alias("place"),
            F.avg("geolocation_lat").alias("avg_latitude"),
            F.avg("geolocation_lng").alias("avg_longitude"),
        )
        .select(
            "geolocation_zip_code_prefix",
            "place.geolocation_city",
            "place.geolocation_state",
            "avg_latitude",
            "avg_longitude",
        )
    )


def clean_payments(
    payments: DataFrame, prefer: Sequence[str] = (), one: Rule = keep_one
) -> DataFrame:
    """De-duplicates before dropping NULL orders. The sequential number stays text here."""
    unique = one(payments, ["order_id", "payment_sequential"], prefer)
    return typed(require(unique, "order_id"), payment_installments="int", payment_value="double")


def clean_reviews(
    reviews: DataFrame, prefer: Sequence[str] = (), one: Rule = keep_one
) -> DataFrame:
    """De-duplicates before dropping NULL orders, preferring a row that has an order."""
    unique = one(reviews, ["review_id"], [F.col("order_id").isNull(), *prefer])
    return typed(
        require(unique, "order_id"),
        review_score="int",
        review_creation_date="date",
        review_answer_timestamp="timestamp",
    )


def clean(
    raw: Mapping[str, DataFrame],
    prefer: Mapping[str, Sequence[str]] | None = None,
    unique: Collection[str] = (),
    total: Collection[str] = (),
) -> Layer:
    """Clean all nine tables. ``prefer`` gives survivor order columns per table.

    ``unique`` names tables whose key repeats nowhere, which ``check_unique_keys`` can
    verify; they are not grouped. ``total`` names tables whose ``prefer`` tells all rows of
    a key apart; of these, only columns that are read are carried through the grouping.
    """
    first = {name: tuple((prefer or {}).get(name, ())) for name in raw}
    one = {
        name: as_is if name in unique else partial(keep_one, total=name in total) for name in raw
    }

    def rules(name: str) -> tuple[Sequence[str], Rule]:
        return first[name], one[name]

    tables = Layer(
        {
            "customers": lambda: clean_customers(raw["customers"], *rules("customers")),
            "orders": lambda: clean_orders(raw["orders"], *rules("orders")),
            "order_items": lambda: clean_order_items(raw["order_items"]),
            "categories": lambda: clean_categories(raw["categories"], *rules("categories")),
            "products": lambda: clean_products(
                raw["products"], tables["categories"], *rules("products")
            ),
            "sellers": lambda: clean_sellers(raw["sellers"], *rules("sellers")),
            "geolocation": lambda: roll_up_geolocation(raw["geolocation"]),
            "payments": lambda: clean_payments(raw["payments"], *rules("payments")),
            "reviews": lambda: clean_reviews(raw["reviews"], *rules("reviews")),
        }
    )
    return tables
