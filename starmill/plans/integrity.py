"""Referential integrity of the clean layer: findings, and the rows that pass."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.layer import Layer, layer
from starmill.operators.matching import keep_matching, lookup, orphan_keys

GEO_ZIP = "geolocation_zip_code_prefix"


def orphan_sellers(tables: Mapping[str, DataFrame]) -> DataFrame:
    return orphan_keys(tables["order_items"], tables["sellers"], "seller_id")


def orphan_products(tables: Mapping[str, DataFrame]) -> DataFrame:
    return orphan_keys(tables["order_items"], tables["products"], "product_id")


def orphan_customer_zips(tables: Mapping[str, DataFrame]) -> DataFrame:
    return orphan_keys(
        tables["customers"], tables["geolocation"], "customer_zip_code_prefix", GEO_ZIP
    )


def orders_without_items(tables: Mapping[str, DataFrame]) -> DataFrame:
    return orphan_keys(tables["orders"], tables["order_items"], "order_id")


CHECKS = {
    "orphan_sellers": orphan_sellers,
    "orphan_products": orphan_products,
    "orphan_customer_zips": orphan_customer_zips,
    "orders_without_items": orders_without_items,
}


def _keys(df: DataFrame, check: str, column: str, child: bool) -> DataFrame:
    """(check, orphan_key, child) of one column."""
    return df.select(
        F.lit(check).alias("check"), F.col(column).cast("string").alias("orphan_key"), F.lit(child).alias("child")
    )


def integrity_findings(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every orphan key as (check, orphan_key), reading each key column once.

    Keys of children and parents meet in one grouping, whose map-side part sends each key
    once per input partition. A NULL key has no parent.
    """
    # Items are children of sellers and products, and what an order needs at least one of.
    items = tables["order_items"]
    children = [
        _keys(items, "orphan_sellers", "seller_id", True),
        _keys(items, "orphan_products", "product_id", True),
        _keys(tables["customers"], "orphan_customer_zips", "customer_zip_code_prefix", True),
        _keys(tables["orders"], "orders_without_items", "order_id", True),
    ]
    parents = [
        _keys(items, "orders_without_items", "order_id", False),
        _keys(tables["sellers"], "orphan_sellers", "seller_id", False),
        _keys(tables["products"], "orphan_products", "product_id", False),
        _keys(tables["geolocation"], "orphan_customer_zips", GEO_ZIP, False),
    ]
    every = reduce(DataFrame.unionByName, [*children, *parents])
    known = ~F.col("child") & F.col("orphan_key").isNotNull()
    return (
        every.groupBy("check", "orphan_key")
        .agg(F.bool_or("child").alias("_child"), F.bool_or(known).alias("_parent"))
        .where("_child and not _parent")
        .select("check", "orphan_key")
    )


def integrity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check (check, orphans), also where nothing was found."""
    found = integrity_findings(tables).groupBy("check").agg(F.count("*").alias("found"))
    names = F.explode(F.array(*[F.lit(name) for name in CHECKS])).alias("check")
    checks = found.sparkSession.range(1).select(names)
    return checks.join(found, "check", "left").select(
        "check", F.coalesce("found", F.lit(0)).alias("orphans")
    )


def with_geolocation(df: DataFrame, geolocation: DataFrame, zip_column: str) -> DataFrame:
    """Rows whose zip prefix is known, widened by the geolocation columns."""
    places = geolocation.withColumn(zip_column, F.col(GEO_ZIP))
    return lookup(df, zip_column, places).select(*df.columns, *geolocation.columns)


def enforce_integrity(tables: Mapping[str, DataFrame]) -> Layer:
    """Drop rows whose parents are missing, from the parents down; one pass suffices.

    Orders without items, customers without orders, and products or sellers never sold
    all stay.
    """

    def located(name: str, zip_column: str) -> DataFrame:
        return with_geolocation(tables[name], tables["geolocation"], zip_column)

    def of_known_order(df: DataFrame) -> DataFrame:
        return keep_matching(df, kept["orders"], "order_id")

    def items() -> DataFrame:
        sold = keep_matching(tables["order_items"], tables["products"], "product_id")
        return of_known_order(keep_matching(sold, kept["sellers"], "seller_id"))

    kept = layer(tables).replacing(
        {
            "sellers": lambda: located("sellers", "seller_zip_code_prefix"),
            "customers": lambda: located("customers", "customer_zip_code_prefix"),
            "orders": lambda: keep_matching(tables["orders"], kept["customers"], "customer_id"),
            "order_items": items,
            "reviews": lambda: of_known_order(tables["reviews"]),
            "payments": lambda: of_known_order(tables["payments"]),
        }
    )
    return kept


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table (table_name, row_count)."""
    counted = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
