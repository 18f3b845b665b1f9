"""Target table layouts, their declared keys, and the projection onto them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layout of the warehouse tables, in load order.
TABLES = {
    "dim_customers": (
        "customer_sk int, customer_id string, customer_unique_id string, "
        "customer_city string, customer_state string, customer_zip_code_prefix string"
    ),
    "dim_sellers": (
        "seller_sk int, seller_id string, seller_city string, seller_state string, "
        "seller_zip_code_prefix string"
    ),
    "dim_products": (
        "product_sk int, product_id string, product_category_english_name string, "
        "product_category_name string, product_name_length int, "
        "product_description_length int, product_photos_qty int, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double"
    ),
    "dim_reviews": (
        "review_sk int, review_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date date, "
        "review_answer_timestamp timestamp"
    ),
    "dim_date": (
        "date_sk int, date date, day int, day_of_week int, month int, year int, quarter int"
    ),
    "fact_orderlifecycle": (
        "order_sk int, order_id string, order_item_id int, customer_sk int, product_sk int, "
        "seller_sk int, order_purchase_date_sk int, order_approved_date_sk int, "
        "shipping_limit_date_sk int, delivered_carrier_date_sk int, "
        "delivered_customer_date_sk int, estimated_delivery_date_sk int, review_sk int, "
        "order_status string, shipping_limit_date timestamp, "
        "order_purchase_timestamp timestamp, order_approved_at timestamp, "
        "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
        "order_estimated_delivery_date timestamp, price double, freight_value double, "
        "total_price double"
    ),
    "fact_orderpayments": (
        "payment_sk int, order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value double, customer_sk int, "
        "payment_date_sk int, payment_timestamp timestamp"
    ),
}

# Declared keys of these tables.
PRIMARY_KEY = {
    "dim_customers": "customer_sk",
    "dim_sellers": "seller_sk",
    "dim_products": "product_sk",
    "dim_reviews": "review_sk",
    "dim_date": "date_sk",
    "fact_orderlifecycle": "order_sk",
    "fact_orderpayments": "payment_sk",
}

UNIQUE_KEY = {
    "dim_customers": "customer_id",
    "dim_sellers": "seller_id",
    "dim_products": "product_id",
    "dim_reviews": "review_id",
    "dim_date": "date",
}

# (child table, child column) -> parent table
FOREIGN_KEY = {
    ("fact_orderlifecycle", "customer_sk"): "dim_customers",
    ("fact_orderlifecycle", "product_sk"): "dim_products",
    ("fact_orderlifecycle", "seller_sk"): "dim_sellers",
    ("fact_orderlifecycle", "order_purchase_date_sk"): "dim_date",
    ("fact_orderlifecycle", "order_approved_date_sk"): "dim_date",
    ("fact_orderlifecycle", "shipping_limit_date_sk"): "dim_date",
    ("fact_orderlifecycle", "delivered_carrier_date_sk"): "dim_date",
    ("fact_orderlifecycle", "delivered_customer_date_sk"): "dim_date",
    ("fact_orderlifecycle", "estimated_delivery_date_sk"): "dim_date",
    ("fact_orderlifecycle", "review_sk"): "dim_reviews",
    ("fact_orderpayments", "customer_sk"): "dim_customers",
    ("fact_orderpayments", "payment_date_sk"): "dim_date",
}

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

INT_MAX = 2**31 - 1


def table_schema(table: str, wide_keys: bool = False) -> T.StructType:
    """Declared schema; ``wide_keys`` turns every ``*_sk`` column into a bigint."""
    fields = []
    for declaration in TABLES[table].split(", "):
        name, kind = declaration.split(" ")
        if wide_keys and name.endswith("_sk"):
            kind = "bigint"
        fields.append(T.StructField(name, _TYPES[kind], name != PRIMARY_KEY[table]))
    return T.StructType(fields)


def columns(table: str) -> list[str]:
    return table_schema(table).names


def _fit(column: Column, actual: T.DataType, declared: T.DataType) -> Column:
    # A number beyond the declared INT must stop the load, not wrap around or turn NULL.
    if isinstance(actual, T.LongType) and isinstance(declared, T.IntegerType):
        too_big = F.raise_error(F.lit("number exceeds INT; load with wide_keys=True if it is a key"))
        return F.when(F.abs(column) > INT_MAX, too_big).otherwise(column).cast(declared)
    return column.try_cast(declared)


def conform(df: DataFrame, table: str, wide_keys: bool = False) -> DataFrame:
    """Project ``df`` onto the declared columns and types of ``table``."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    picked = []
    for field in table_schema(table, wide_keys).fields:
        column = F.col(field.name)
        if actual[field.name] != field.dataType:
            column = _fit(column, actual[field.name], field.dataType).alias(field.name)
        picked.append(column)
    return df.select(*picked)


def schema_mismatches(df: DataFrame, table: str, wide_keys: bool = False) -> list[str]:
    """Differences between a frame and the declared table, one line each; empty if none."""
    declared = {f.name: f.dataType for f in table_schema(table, wide_keys).fields}
    actual = {f.name: f.dataType for f in df.schema.fields}
    found = [f"missing {name}" for name in declared if name not in actual]
    found += [f"undeclared {name}" for name in actual if name not in declared]
    found += [
        f"{name} is {actual[name].simpleString()}, declared {declared[name].simpleString()}"
        for name in declared
        if name in actual and actual[name] != declared[name]
    ]
    if not found and list(actual) != list(declared):
        found.append("column order differs")
    return found
