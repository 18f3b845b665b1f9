"""Clean layer to warehouse layer: five dimensions and two facts."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill import schemas
from starmill.functions.calendar import (
    add_date_keys,
    date_attributes,
    date_bounds,
    date_spine,
    event_dates,
)
from starmill.functions.casts import typed
from starmill.operators.dedup import require
from starmill.operators.keys import SAMPLED, Ranges, range_count, spread_key, surrogate_key
from starmill.operators.matching import keep_matching, lookup, wanted_orders
from starmill.plans.integrity import GEO_ZIP
from starmill.staging import new_folder, release_staged, stage

# Key column of the order fact -> the day it refers to.
LIFECYCLE_DATE_KEYS = {
    "order_purchase_date_sk": "order_purchase_date",
    "order_approved_date_sk": "order_approved_date",
    "shipping_limit_date_sk": "shipping_limit_day",
    "delivered_carrier_date_sk": "delivered_carrier_date",
    "delivered_customer_date_sk": "delivered_customer_date",
    "estimated_delivery_date_sk": "estimated_delivery_date",
}


def review_links(orders: DataFrame, reviews: DataFrame, *named: str) -> DataFrame:
    """One row per (order, review), and one with NULL review for each order without any.
    ``named`` columns of the review go along.

    Joining items to this table with an inner join gives what a left join to the reviews
    gives, but an inner join lets Spark split a very large order on either side.
    """
    reviewed = reviews.select("order_id").distinct()
    silent = orders.select("order_id").join(reviewed, "order_id", "left_anti")
    linked = reviews.select("order_id", "review_id", "review_sk", *named)
    return linked.unionByName(silent, allowMissingColumns=True)


def numbered_items(items: DataFrame) -> DataFrame:
    """Items with their number as a number, and its text as ``item_text``."""
    return items.withColumn("item_text", F.col("order_item_id")).transform(typed, order_item_id="bigint")


def numbered_payments(payments: DataFrame) -> DataFrame:
    """Payments with their number as a number, and its text as ``sequential_text``."""
    return payments.withColumn("sequential_text", F.col("payment_sequential")).transform(
        typed, payment_sequential="bigint"
    )


@dataclass(frozen=True)
class Warehouse:
    """Warehouse tables over clean tables; each is built when first asked for.

    Tables that others refer to are staged, so that all agree on their keys; facts are not,
    their keys follow from cuts that are fixed beforehand. The tables may
    be clean or already enforced: the joins below drop the same rows as enforcement.

    ``closed`` says whether the date spine includes the first purchase day (``both``) or
    starts a day later (``right``). ``text_item_order`` numbers the order fact by the
    text of the item number. ``date_columns`` are further order timestamps that widen
    the spine. ``key_method`` is that of :func:`surrogate_key`, or ``natural``: dimensions
    are then keyed by their natural key, facts are not numbered and nothing is staged,
    which is all that a measure needs.
    """

    tables: Mapping[str, DataFrame]
    closed: str = "both"
    text_item_order: bool = False
    date_columns: Sequence[str] = ()
    key_method: str = "ranged"

    @cached_property
    def folder(self) -> str:
        """Where this warehouse stages tables; no other one writes there."""
        return new_folder(self.tables["orders"].sparkSession)

    def release(self) -> None:
        """Delete what this warehouse has staged. Its tables become unreadable."""
        release_staged(self.tables["orders"].sparkSession, self.folder)

    def _dimension_key(self, df: DataFrame, name: str, natural: str) -> DataFrame:
        if self.key_method == "natural":
            return df.select(F.col(natural).alias(name), "*")
        return surrogate_key(df, name, [natural], method=self.key_method, folder=self.folder)

    def _numbered(
        self,
        df: DataFrame,
        table: str,
        keys: Sequence[str],
        source: DataFrame,
        widen: Callable[[DataFrame], DataFrame] = lambda sample: sample,
    ) -> DataFrame:
        """``df`` with the key of a fact table, reduced to that table's columns.

        ``source`` is a cheap frame of about as many rows that has some of the leading
        ``keys``; ``widen`` brings a sample of it closer to how keys are distributed in ``df``.
        """
        name, *wanted = schemas.columns(table)
        if self.key_method == "natural":
            raise ValueError(f"{table} needs numbered keys")
        keep = [c for c in wanted if c in df.columns]
        if self.key_method != "ranged":
            return surrogate_key(df, name, keys, keep, self.key_method)
        spark = df.sparkSession
        rows = source.count()
        count = range_count(spark, rows)
        few = source.sample(min(1.0, SAMPLED * count / max(rows, 1)), seed=1)
        sample = widen(few)
        leading = list(itertools.takewhile(sample.columns.__contains__, keys))
        ranges = Ranges.of(sample, leading, count, self.folder)
        numbered, self._sizes[table] = spread_key(df, name, keys, ranges, keep, self.folder)
        return numbered

    @cached_property
    def _sizes(self) -> dict[str, int]:
        """Rows of the fact tables that have been numbered."""
        return {}

    def size(self, name: str) -> int:
        """How many rows a table has; a numbered fact knows without being computed again."""
        table = self.table(name)
        return self._sizes[name] if name in self._sizes else table.count()

    def _entity(self, df: DataFrame, table: str, **renamed: str) -> DataFrame:
        sk, natural = schemas.PRIMARY_KEY[table], schemas.UNIQUE_KEY[table]
        wanted = [c for c in schemas.columns(table) if c != sk]
        known = require(df, natural).withColumnsRenamed(renamed).select(*wanted)
        return self._dimension_key(known, sk, natural)

    @cached_property
    def dim_customers(self) -> DataFrame:
        customers = keep_matching(
            self.tables["customers"],
            self.tables["geolocation"],
            "customer_zip_code_prefix",
            GEO_ZIP,
        )
        return self._entity(customers, "dim_customers")

    @cached_property
    def dim_sellers(self) -> DataFrame:
        sellers = keep_matching(
            self.tables["sellers"], self.tables["geolocation"], "seller_zip_code_prefix", GEO_ZIP
        )
        return self._entity(sellers, "dim_sellers")

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._entity(
            self.tables["products"],
            "dim_products",
            product_category_name_english="product_category_english_name",
            product_name_lenght="product_name_length",
            product_description_lenght="product_description_length",
        )

    @cached_property
    def orders(self) -> DataFrame:
        """Orders of known customers, with the customer's key."""
        customers = self.dim_customers.select("customer_id", "customer_sk")
        known = lookup(self.tables["orders"], "customer_id", customers)
        return known if self.key_method == "natural" else stage(known, "orders", self.folder)

    @cached_property
    def reviews(self) -> DataFrame:
        """Reviews of known orders, with their key and still with their order."""
        known = keep_matching(self.tables["reviews"], self.orders, "order_id")
        wanted = [c for c in schemas.columns("dim_reviews") if c != "review_sk"]
        named = require(known, "review_id").select(*wanted, "order_id")
        return self._dimension_key(named, "review_sk", "review_id")

    @property
    def dim_reviews(self) -> DataFrame:
        return self.reviews.drop("order_id")

    @cached_property
    def date_bounds(self) -> DataFrame:
        return date_bounds(self.orders, self.date_columns)

    @cached_property
    def dim_date(self) -> DataFrame:
        return date_attributes(date_spine(self.date_bounds, self.closed))

    def _items_of(
        self,
        *tables: DataFrame,
        product: Sequence[str] = (),
        seller: Sequence[str] = (),
        items: DataFrame | None = None,
    ) -> DataFrame:
        """Items of known products and sellers, joined to tables by order.

        ``product`` and ``seller`` name further columns of theirs to carry along.
        """
        products = self.dim_products.select("product_id", "product_sk", *product)
        sellers = self.dim_sellers.select("seller_id", "seller_sk", *seller)
        items = self.tables["order_items"] if items is None else items
        items = lookup(items, "product_id", products)
        return numbered_items(lookup(lookup(items, "seller_id", sellers), "order_id", *tables))

    @cached_property
    def item_rows(self) -> DataFrame:
        """Every item with every review of its order, and the keys of its entities."""
        # Links before orders: the first join of the two is where a large order on either
        # side gets split, and once split the second join is shuffled and split as well.
        return self._items_of(review_links(self.orders, self.reviews), self.orders)

    @cached_property
    def sales_rows(self) -> DataFrame:
        """The order fact without number and before reviews repeat its items.

        Measures that count an item or an order once give the same on these rows.
        """
        return self._lifecycle(self._items_of(self.orders))

    def order_detail(self, orders: DataFrame | Sequence[str] | None = None) -> DataFrame:
        """The order fact of the given orders (all if None) with what its keys stand for.

        Names travel with the lookups that find the keys, so each entity is joined once.
        Rows are not numbered. Year and month are NULL outside the date spine.
        """
        customers = self.dim_customers.select(
            "customer_id", "customer_sk", "customer_city", "customer_state"
        )
        known = lookup(self.tables["orders"], "customer_id", customers)
        items = self.tables["order_items"]
        if orders is not None:
            known, items = (wanted_orders(df, orders) for df in (known, items))
        rows = self._items_of(
            review_links(known, self.reviews, "review_score"),
            known,
            product=["product_category_english_name"],
            seller=["seller_city"],
            items=items,
        )
        placed = F.col("order_purchase_timestamp")
        dated = F.col("order_purchase_date_sk").isNotNull()
        return self._lifecycle(rows).withColumns(
            {
                "purchase_year": F.when(dated, F.year(placed)),
                "purchase_month": F.when(dated, F.month(placed)),
            }
        )

    def _dated(self, df: DataFrame, days: Mapping[str, str]) -> DataFrame:
        return add_date_keys(df, dict(days), self.date_bounds, self.closed)

    def _lifecycle(self, items: DataFrame) -> DataFrame:
        dated = self._dated(event_dates(items), LIFECYCLE_DATE_KEYS)
        return dated.withColumn("total_price", F.col("price") + F.col("freight_value"))

    @cached_property
    def lifecycle_rows(self) -> DataFrame:
        """The order fact without its number."""
        return self._lifecycle(self.item_rows)

    @cached_property
    def fact_orderlifecycle(self) -> DataFrame:
        return self._number_items(self.item_rows)

    def _number_items(self, rows: DataFrame) -> DataFrame:
        numeric = [] if self.text_item_order else ["order_item_id"]
        # review_sk orders like review_id. What follows it only matters where an item
        # number repeats in an order.
        keys = ["order_id", *numeric, "item_text", "review_sk", "product_sk", "seller_sk"]
        keys += ["shipping_limit_date", "price", "freight_value"]

        items = numbered_items(self.tables["order_items"]).select("order_id", *numeric, "item_text")

        def reviewed(sample: DataFrame) -> DataFrame:
            # An order with many reviews has its items many times.
            return sample.join(self.reviews.select("order_id", "review_sk"), "order_id", "left")

        # Date keys and the total are derived after the numbering, so they are not shuffled.
        rows = self._numbered(rows, "fact_orderlifecycle", keys, items, reviewed)
        return self._lifecycle(rows)

    @cached_property
    def order_payments(self) -> DataFrame:
        """Every payment of a known order, dated by the order's purchase."""
        orders = self.orders.select(
            "order_id", "customer_sk", F.col("order_purchase_timestamp").alias("payment_timestamp")
        )
        return numbered_payments(lookup(self.tables["payments"], "order_id", orders))

    def _payments(self, payments: DataFrame) -> DataFrame:
        days = payments.withColumn("payment_day", F.to_date("payment_timestamp"))
        return self._dated(days, {"payment_date_sk": "payment_day"})

    @cached_property
    def payment_rows(self) -> DataFrame:
        """The payment fact without its number."""
        return self._payments(self.order_payments)

    @cached_property
    def fact_orderpayments(self) -> DataFrame:
        return self._number_payments(self.order_payments)

    def _number_payments(self, rows: DataFrame) -> DataFrame:
        keys = ["order_id", "payment_sequential", "sequential_text"]

        source = numbered_payments(self.tables["payments"].select("order_id", "payment_sequential"))
        return self._payments(self._numbered(rows, "fact_orderpayments", keys, source))

    def table(self, name: str) -> DataFrame:
        """A warehouse table by its declared name, surrogate keys as bigint."""
        if name not in schemas.TABLES:
            raise KeyError(name)
        return getattr(self, name).select(*schemas.columns(name))

    def prepare(self, names: Sequence[str] = tuple(schemas.TABLES)) -> None:
        """Build tables and stage what they share; independent ones at the same time."""
        self.folder, self._sizes  # made here, not by whichever table asks first
        entities = ["dim_customers", "dim_sellers", "dim_products"]
        facts = [t for t in ("fact_orderlifecycle", "fact_orderpayments") if t in names]
        if "fact_orderlifecycle" not in names:
            entities = [t for t in entities if t in names or (facts and t == "dim_customers")]
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(self.table, entities))
            if {"dim_reviews", "fact_orderlifecycle"} & set(names):
                self.reviews
            if {"dim_date", *facts} & set(names):
                self.dim_date
            list(pool.map(self.table, facts))

    def referring_rows(self) -> dict[str, DataFrame]:
        """All tables, facts without their numbers: what references can be checked on before
        anything is sorted or written."""
        self.prepare([t for t in schemas.TABLES if not t.startswith("fact_")])
        facts = {"fact_orderlifecycle": self.lifecycle_rows, "fact_orderpayments": self.payment_rows}
        return {t: facts[t] if t in facts else self.table(t) for t in schemas.TABLES}

    def all_tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in schemas.TABLES}
