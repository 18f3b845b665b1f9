"""The registered queries: every operator of the engine over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill import schemas
from starmill.functions import calendar
from starmill.functions.casts import as_text
from starmill.layer import Layer
from starmill.operators import constraints
from starmill.operators.dedup import keep_one, require
from starmill.operators.matching import keep_matching
from starmill.plans import clean as cleaning
from starmill.plans import integrity, measures
from starmill.plans.increment import load
from starmill.plans.model import LIFECYCLE_DATE_KEYS, Warehouse
from starmill.sources import adapter
from starmill.sources.store import Store
from starmill.staging import new_folder

# Survivors of de-duplication: the row that arrived first, which no other shares.
ARRIVAL = {"payments": ["arrival"], "reviews": ["arrival"]}
# The job takes orders as they come; dedup_orders shows what repeats would do.
UNIQUE = ("orders",)


def _clean(raw: Layer) -> Layer:
    return cleaning.clean(raw, ARRIVAL, unique=UNIQUE, total=tuple(ARRIVAL))


class Inputs:
    """All layers over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @cached_property
    def raw(self) -> Layer:
        return adapter.raw_tables(self.spark, self.folder)

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/events.parquet")

    @cached_property
    def clean(self) -> Layer:
        return _clean(self.raw)

    @cached_property
    def enforced(self) -> Layer:
        return integrity.enforce_integrity(self.clean)

    @cached_property
    def gaps(self) -> Layer:
        """Clean tables with unknown zips and categories, for the referential checks."""
        return _clean(adapter.with_gaps(self.raw))

    @cached_property
    def gaps_enforced(self) -> Layer:
        return integrity.enforce_integrity(self.gaps)

    @cached_property
    def gaps_with_enforced_sellers(self) -> Layer:
        return self.gaps.replacing({"sellers": lambda: self.gaps_enforced["sellers"]})

    @cached_property
    def warehouse(self) -> Warehouse:
        return Warehouse(self.clean, closed="right", text_item_order=True)

    @cached_property
    def unnumbered(self) -> Warehouse:
        """The warehouse for measures, which read keys only to tell entities apart."""
        return Warehouse(self.clean, closed="right", key_method="natural")


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _failed() -> Column:
    return F.col("event_type") == "error"


def _without_arrival(df: DataFrame) -> DataFrame:
    return df.drop("arrival")


# --- cleaning and scalar expressions ------------------------------------------------


def clean_drop_null_keys(x: Inputs) -> DataFrame:
    return require(_without_arrival(adapter.payments(x.events, _failed())), "order_id")


def typed_orders(x: Inputs) -> DataFrame:
    return cleaning.type_orders(as_text(x.raw["orders"]))


def typed_order_items(x: Inputs) -> DataFrame:
    return cleaning.type_order_items(as_text(x.raw["order_items"]))


def typed_products(x: Inputs) -> DataFrame:
    return cleaning.type_products(as_text(x.raw["products"]))


def event_dates(x: Inputs) -> DataFrame:
    days = [d for d in calendar.EVENT_DATES if d != "shipping_limit_day"]
    return calendar.event_dates(x.clean["orders"]).select("order_id", *days)


def shipping_limit_days(x: Inputs) -> DataFrame:
    dated = calendar.event_dates(x.clean["order_items"])
    return dated.select("order_id", "order_item_id", "shipping_limit_day")


def date_attributes(x: Inputs) -> DataFrame:
    days = x.clean["orders"].select("order_id", F.to_date("order_purchase_timestamp").alias("date"))
    return calendar.date_attributes(days)


def item_total_price(x: Inputs) -> DataFrame:
    total = (F.col("price") + F.col("freight_value")).alias("total_price")
    return x.clean["order_items"].select("order_id", "order_item_id", total)


def dedup_reviews(x: Inputs) -> DataFrame:
    return _without_arrival(x.clean["reviews"])


def dedup_payments(x: Inputs) -> DataFrame:
    return _without_arrival(x.clean["payments"])


def dedup_orders(x: Inputs) -> DataFrame:
    """Repeated orders: the smallest row survives, here the one of the earlier status."""
    return cleaning.clean_orders(adapter.repeated_orders(x.raw["orders"]), ["order_status"])


def dimensions_from_repeats(x: Inputs) -> DataFrame:
    """Dimensions from tables in which every third entity comes twice: the smaller row survives."""
    repeats = {n: partial(adapter.repeated, x.raw[n], *adapter.REPEATS[n]) for n in adapter.REPEATS}
    built = Warehouse(_clean(x.raw.replacing(repeats)), closed="right")
    shown = {"dim_customers": "customer_city", "dim_sellers": "seller_city", "dim_products": "product_photos_qty"}
    found = []
    for table, attribute in shown.items():
        key = [schemas.PRIMARY_KEY[table], schemas.UNIQUE_KEY[table], attribute]
        found.append(
            built.table(table).select(
                F.lit(table).alias("table_name"), F.col(key[0]).alias("sk"), F.col(key[1]).alias("id"),
                F.col(key[2]).cast("string").alias("attribute"),
            )
        )
    return reduce(DataFrame.union, found)


def unreadable_numbers(x: Inputs) -> DataFrame:
    return cleaning.type_order_items(adapter.unreadable_items(x.raw["order_items"]))


def dedup_then_dropna(x: Inputs) -> DataFrame:
    """The first arrival survives even without an order, and is dropped after that."""
    unique = keep_one(adapter.reviews(x.events, _failed()), ["review_id"], ["arrival"])
    return _without_arrival(require(unique, "order_id"))


def dedup_prefers_order(x: Inputs) -> DataFrame:
    """The same input through the job's own rule, which prefers a row with an order."""
    lossy = adapter.reviews(x.events, _failed())
    return _without_arrival(cleaning.clean_reviews(lossy, ["arrival"]))


def geolocation_rollup(x: Inputs) -> DataFrame:
    return _rounded(x.clean["geolocation"], 6, "avg_latitude", "avg_longitude")


def products_translated(x: Inputs) -> DataFrame:
    return x.clean["products"]


# --- integrity ----------------------------------------------------------------------


def orphan_sellers(x: Inputs) -> DataFrame:
    return integrity.orphan_sellers(x.gaps_with_enforced_sellers)


def orphan_products(x: Inputs) -> DataFrame:
    return integrity.orphan_products(x.gaps)


def orphan_customer_zips(x: Inputs) -> DataFrame:
    return integrity.orphan_customer_zips(x.gaps)


def orders_without_items(x: Inputs) -> DataFrame:
    return integrity.orders_without_items(x.gaps)


def integrity_findings(x: Inputs) -> DataFrame:
    return integrity.integrity_findings(x.gaps_with_enforced_sellers)


def integrity_report(x: Inputs) -> DataFrame:
    return integrity.integrity_report(x.gaps_with_enforced_sellers)


def items_with_valid_product(x: Inputs) -> DataFrame:
    return keep_matching(x.gaps["order_items"], x.gaps["products"], "product_id")


def items_with_valid_seller(x: Inputs) -> DataFrame:
    return keep_matching(items_with_valid_product(x), x.gaps_enforced["sellers"], "seller_id")


def items_with_valid_order(x: Inputs) -> DataFrame:
    return x.gaps_enforced["order_items"]


def sellers_with_geo(x: Inputs) -> DataFrame:
    return _rounded(x.gaps_enforced["sellers"], 6, "avg_latitude", "avg_longitude")


def customers_with_geo(x: Inputs) -> DataFrame:
    return _rounded(x.gaps_enforced["customers"], 6, "avg_latitude", "avg_longitude")


def orders_with_valid_customer(x: Inputs) -> DataFrame:
    return x.gaps_enforced["orders"]


def reviews_with_valid_order(x: Inputs) -> DataFrame:
    return _without_arrival(x.gaps_enforced["reviews"])


def payments_with_valid_order(x: Inputs) -> DataFrame:
    return _without_arrival(x.gaps_enforced["payments"])


def cascade_row_counts(x: Inputs) -> DataFrame:
    return integrity.row_counts(x.gaps_enforced)


# --- calendar -----------------------------------------------------------------------


def purchase_date_bounds(x: Inputs) -> DataFrame:
    return calendar.date_bounds(x.enforced["orders"])


def date_spine(x: Inputs) -> DataFrame:
    return calendar.date_spine(purchase_date_bounds(x), "right")


def date_spine_inclusive(x: Inputs) -> DataFrame:
    return calendar.date_spine(purchase_date_bounds(x), "both")


# --- warehouse tables ---------------------------------------------------------------


def _table(name: str) -> Callable[[Inputs], DataFrame]:
    return lambda x: x.warehouse.table(name)


def fact_review_fanout(x: Inputs) -> DataFrame:
    return x.warehouse.lifecycle_rows.select("order_id", "order_item_id", "review_id", "review_sk")


def fact_date_keys(x: Inputs) -> DataFrame:
    return x.warehouse.lifecycle_rows.select(
        "order_id", "order_item_id", "review_id", *LIFECYCLE_DATE_KEYS
    )


def _in_two_loads(x: Inputs, *names: str) -> Store:
    """The whole input, loaded twice after the orders placed before 1998 and their customers."""
    early = x.clean["orders"].where("order_purchase_timestamp < DATE'1998-01-01'")
    first = x.clean.replacing(
        {
            "orders": lambda: early,
            "customers": lambda: keep_matching(x.clean["customers"], early, "customer_id"),
        }
    )
    store = Store(x.spark, new_folder(x.spark))
    for tables in (first, x.clean, x.clean):
        load(x.spark, tables, store.root, names=names, closed="right", wide_keys=True)
    return store


def dim_customers_incremental(x: Inputs) -> DataFrame:
    return _in_two_loads(x, "dim_customers").read("dim_customers")


def fact_payments_incremental(x: Inputs) -> DataFrame:
    names = ("dim_customers", "dim_date", "fact_orderpayments")
    return _in_two_loads(x, *names).read("fact_orderpayments")


def conform_fact_payments(x: Inputs) -> DataFrame:
    return schemas.conform(x.warehouse.table("fact_orderpayments"), "fact_orderpayments")


def check_primary_keys(x: Inputs) -> DataFrame:
    x.warehouse.prepare()
    return constraints.check_primary_keys(x.warehouse.all_tables())


def check_unique_keys(x: Inputs) -> DataFrame:
    return constraints.check_unique_keys({t: x.warehouse.table(t) for t in schemas.UNIQUE_KEY})


def check_foreign_keys(x: Inputs) -> DataFrame:
    return constraints.check_foreign_keys(x.warehouse.referring_rows())


# --- measures -----------------------------------------------------------------------


def total_sales(x: Inputs) -> DataFrame:
    return _rounded(measures.total_sales(x.unnumbered.sales_rows), 2, "total_sales")


def total_sales_from_fact(x: Inputs) -> DataFrame:
    fact = x.warehouse.table("fact_orderlifecycle")
    return _rounded(measures.total_sales(fact), 2, "total_sales")


def order_count(x: Inputs) -> DataFrame:
    return measures.order_count(x.unnumbered.sales_rows)


def on_time_delivery(x: Inputs) -> DataFrame:
    return _rounded(measures.on_time_delivery(x.unnumbered.sales_rows), 6, "on_time_pct")


def payment_mix(x: Inputs) -> DataFrame:
    mix = measures.payment_mix(x.unnumbered.payment_rows)
    return _rounded(_rounded(mix, 2, "value"), 6, "value_pct")


def payments_mom(x: Inputs) -> DataFrame:
    months = measures.payments_month_over_month(x.unnumbered.payment_rows)
    return _rounded(_rounded(months, 2, "value", "previous_value"), 6, "growth_pct")


def customer_segments(x: Inputs) -> DataFrame:
    w = x.unnumbered
    return _rounded(measures.customer_segments(w.payment_rows, w.dim_customers, folder=w.folder), 2, "spend")


def segment_summary(x: Inputs) -> DataFrame:
    w = x.unnumbered
    segments = measures.customer_segments(w.payment_rows, w.dim_customers, folder=w.folder)
    return _rounded(measures.segment_summary(segments), 2, "spend")


def review_nps(x: Inputs) -> DataFrame:
    return _rounded(measures.review_nps(x.unnumbered.dim_reviews), 6, "nps")


def sales_by_month(x: Inputs) -> DataFrame:
    return _rounded(measures.sales_by_month(x.unnumbered.sales_rows), 2, "total_sales")


def sales_by_category(x: Inputs) -> DataFrame:
    w = x.unnumbered
    return _rounded(measures.sales_by_category(w.sales_rows, w.dim_products), 2, "total_sales")


def sales_by_state(x: Inputs) -> DataFrame:
    w = x.unnumbered
    return _rounded(measures.sales_by_state(w.sales_rows, w.dim_customers), 2, "total_sales")


def lifecycle_by_status(x: Inputs) -> DataFrame:
    by_status = measures.lifecycle_by_status(x.unnumbered.sales_rows)
    return _rounded(by_status, 6, *measures.LIFECYCLE_STEPS)


DETAIL = (
    "order_id order_item_id order_status shipping_limit_date order_purchase_timestamp "
    "order_approved_at order_delivered_carrier_date order_delivered_customer_date "
    "order_estimated_delivery_date price freight_value total_price customer_id customer_city "
    "customer_state product_id product_category_english_name seller_id seller_city review_id "
    "review_score purchase_year purchase_month"
).split()


def order_detail(x: Inputs) -> DataFrame:
    return x.unnumbered.order_detail().select(*DETAIL)


def order_payment_detail(x: Inputs) -> DataFrame:
    w = x.unnumbered
    payments = w.payment_rows.select(
        *[c for c in schemas.columns("fact_orderpayments") if c != "payment_sk"]
    )
    return measures.order_payment_detail(payments, w.dim_customers).drop("customer_sk")


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    q.__name__: q
    for q in (
        clean_drop_null_keys,
        typed_orders,
        typed_order_items,
        typed_products,
        event_dates,
        shipping_limit_days,
        date_attributes,
        item_total_price,
        dedup_reviews,
        dedup_payments,
        dedup_orders,
        dimensions_from_repeats,
        unreadable_numbers,
        dedup_then_dropna,
        dedup_prefers_order,
        geolocation_rollup,
        products_translated,
        orphan_sellers,
        orphan_products,
        orphan_customer_zips,
        orders_without_items,
        integrity_findings,
        integrity_report,
        items_with_valid_product,
        items_with_valid_seller,
        items_with_valid_order,
        sellers_with_geo,
        customers_with_geo,
        orders_with_valid_customer,
        reviews_with_valid_order,
        payments_with_valid_order,
        cascade_row_counts,
        purchase_date_bounds,
        date_spine,
        date_spine_inclusive,
        fact_review_fanout,
        fact_date_keys,
        dim_customers_incremental,
        fact_payments_incremental,
        conform_fact_payments,
        check_primary_keys,
        check_unique_keys,
        check_foreign_keys,
        total_sales,
        total_sales_from_fact,
        order_count,
        on_time_delivery,
        payment_mix,
        payments_mom,
        customer_segments,
        segment_summary,
        review_nps,
        sales_by_month,
        sales_by_category,
        sales_by_state,
        lifecycle_by_status,
        order_detail,
        order_payment_detail,
    )
} | {name: _table(name) for name in schemas.TABLES}


def _days_as_text(df: DataFrame) -> DataFrame:
    """Days as yyyy-mm-dd text, so that results compare alike across engines."""
    days = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({d: F.col(d).cast("string") for d in days}) if days else df


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return _days_as_text(QUERIES[name](Inputs(spark, folder)))
