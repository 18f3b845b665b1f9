"""Dashboard measures over the warehouse tables. Each states the grain it sums at.

The order fact holds an item once per review of its order, so sums over it start from
:func:`item_grain`. ``Warehouse.sales_rows`` is at item grain already, and is recognised by
having no review key. All measures take an optional tuple of order statuses to keep.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.operators.matching import lookup, wanted_orders
from starmill.operators.quantiles import exact_quantiles
from starmill.staging import stage


def with_status(fact: DataFrame, statuses: Sequence[str] | None) -> DataFrame:
    return fact.where(F.col("order_status").isin(*statuses)) if statuses else fact


def item_grain(fact: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """The order fact with every item once, also items whose number repeats or is unreadable.

    Every item of an order meets every review of it, so the rows that carry the order's
    first review (or none, where it has none) are its items.
    """
    items = with_status(fact, statuses)
    if "review_sk" not in items.columns:
        return items
    first = items.groupBy("order_id").agg(F.min("review_sk").alias("_first"))
    kept = lookup(items, "order_id", first).where(F.col("review_sk").eqNullSafe(F.col("_first")))
    return kept.drop("_first")


def order_grain(fact: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """The order fact with one row per order and its event times."""
    moments = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    return (
        with_status(fact, statuses)
        .groupBy("order_id", "order_status")
        .agg(*[F.max(c).alias(c) for c in moments])
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, 100.0 * part / whole)


def total_sales(fact: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Sum of total_price, each item once."""
    return item_grain(fact, statuses).agg(F.sum("total_price").alias("total_sales"))


def order_count(fact: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Orders with at least one item."""
    return with_status(fact, statuses).agg(F.count_distinct("order_id").alias("orders"))


def on_time_delivery(fact: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Delivered orders, those delivered by the estimated day, and their percentage."""
    orders = order_grain(fact, statuses)
    delivered = F.to_date("order_delivered_customer_date")
    in_time = delivered <= F.to_date("order_estimated_delivery_date")
    counts = orders.agg(
        F.count_if(in_time).alias("on_time_orders"), F.count(delivered).alias("delivered_orders")
    )
    share = _percent(F.col("on_time_orders"), F.col("delivered_orders"))
    return counts.withColumn("on_time_pct", share)


def payment_mix(payments: DataFrame) -> DataFrame:
    """Per payment type: payments, value, and percentage of all value."""
    by_type = payments.groupBy("payment_type").agg(
        F.count("*").alias("payments"), F.sum("payment_value").alias("value")
    )
    # One row per payment type, so one task is enough.
    total = F.sum("value").over(Window.partitionBy())
    return by_type.withColumn("value_pct", _percent(F.col("value"), total))


def payments_month_over_month(payments: DataFrame) -> DataFrame:
    """Value per calendar month, and its growth over the month before.

    Months without payments count as 0. Growth is NULL for the first month, and where
    the month before has no value.
    """
    paid = payments.groupBy(F.trunc("payment_timestamp", "month").alias("month")).agg(
        F.sum("payment_value").alias("value")
    )
    ends = paid.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    months = ends.where("first is not null").select(
        F.explode(F.expr("sequence(first, last, interval 1 month)")).alias("month")
    )
    filled = months.join(paid, "month", "left").select(
        "month", F.coalesce("value", F.lit(0.0)).alias("value")
    )
    # At most one row per month of the calendar, so one task is enough.
    before = F.lag("value").over(Window.orderBy("month"))
    growth = _percent(F.expr("value - previous_value"), F.col("previous_value"))
    return filled.withColumn("previous_value", before).withColumn("growth_pct", growth)


def customer_spend(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Payments per person (customer_unique_id), added up per customer key first."""
    per_key = payments.groupBy("customer_sk").agg(F.sum("payment_value").alias("spend"))
    people = customers.select("customer_sk", "customer_unique_id")
    return (
        lookup(per_key, "customer_sk", people)
        .groupBy("customer_unique_id")
        .agg(F.sum("spend").alias("spend"))
    )


def customer_segments(
    payments: DataFrame,
    customers: DataFrame,
    cut_points: tuple[float, float] | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Each paying person as High, Medium or Low.

    The cut points are the exact 1/3 and 2/3 quantiles of spend unless given. For these the
    spend is staged in ``folder``, say that of the warehouse, whose release deletes it.
    """
    spend = customer_spend(payments, customers)
    if cut_points is None:
        # Both the ranking and the result read it.
        spend = stage(spend, "spend", folder)
        cuts = exact_quantiles(
            spend, "spend", {"lower": (1, 3), "upper": (2, 3)}, "customer_unique_id", folder
        )
        limits = cuts.select(F.struct("lower", "upper")).scalar()
    else:
        lower, upper = (F.lit(float(c)) for c in cut_points)
        limits = F.struct(lower.alias("lower"), upper.alias("upper"))
    segment = (
        F.when(F.col("spend") >= F.col("_cut.upper"), "High")
        .when(F.col("spend") >= F.col("_cut.lower"), "Medium")
        .otherwise("Low")
    )
    return spend.withColumn("_cut", limits).withColumn("segment", segment).drop("_cut")


def segment_summary(segments: DataFrame) -> DataFrame:
    """People and spend per segment."""
    return segments.groupBy("segment").agg(
        F.count("*").alias("customers"), F.sum("spend").alias("spend")
    )


def review_nps(reviews: DataFrame) -> DataFrame:
    """Promoters (5) minus detractors (3 and less) in percent of scored reviews."""
    score = F.col("review_score")
    counts = reviews.agg(
        F.count_if(score == 5).alias("promoters"),
        F.count_if(score == 4).alias("passives"),
        F.count_if(score <= 3).alias("detractors"),
        F.count(score).alias("scored"),
    )
    return counts.withColumn("nps", _percent(F.expr("promoters - detractors"), F.col("scored")))


def _sales(items: DataFrame, by: str) -> DataFrame:
    """Sales and distinct orders per group, over one row per (order, group)."""
    per_order = items.groupBy(by, "order_id").agg(F.sum("total_price").alias("total_price"))
    return per_order.groupBy(by).agg(
        F.sum("total_price").alias("total_sales"), F.count("*").alias("orders")
    )


def sales_by_month(fact: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    month = F.trunc("order_purchase_timestamp", "month")
    return _sales(item_grain(fact, statuses).withColumn("month", month), "month")


def sales_by_category(
    fact: DataFrame, products: DataFrame, statuses: Sequence[str] | None = None
) -> DataFrame:
    named = products.select("product_sk", F.col("product_category_english_name").alias("category"))
    return _sales(lookup(item_grain(fact, statuses), "product_sk", named), "category")


def sales_by_state(
    fact: DataFrame, customers: DataFrame, statuses: Sequence[str] | None = None
) -> DataFrame:
    """By the customer's state. An order has one customer, so customers are added up first."""
    per_order = item_grain(fact, statuses).groupBy("customer_sk", "order_id").agg(
        F.sum("total_price").alias("total_price")
    )
    per_customer = per_order.groupBy("customer_sk").agg(
        F.sum("total_price").alias("total_sales"), F.count("*").alias("orders")
    )
    states = customers.select("customer_sk", "customer_state")
    return (
        lookup(per_customer, "customer_sk", states)
        .groupBy("customer_state")
        .agg(F.sum("total_sales").alias("total_sales"), F.sum("orders").alias("orders"))
    )


# Average days from the second event to the first, per output column.
LIFECYCLE_STEPS = {
    "days_to_approval": ("order_approved_at", "order_purchase_timestamp"),
    "days_to_carrier": ("order_delivered_carrier_date", "order_approved_at"),
    "days_to_customer": ("order_delivered_customer_date", "order_delivered_carrier_date"),
    "days_past_estimate": ("order_delivered_customer_date", "order_estimated_delivery_date"),
}


def lifecycle_by_status(fact: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Per status: orders, and average calendar days of each step. Order grain."""
    steps = [
        F.avg(F.date_diff(F.to_date(end), F.to_date(start))).alias(name)
        for name, (end, start) in LIFECYCLE_STEPS.items()
    ]
    by_status = order_grain(fact, statuses).groupBy("order_status")
    return by_status.agg(F.count("*").alias("orders"), *steps)


def _wanted(df: DataFrame, orders: DataFrame | Sequence[str] | None) -> DataFrame:
    return df if orders is None else wanted_orders(df, orders)


def order_detail(
    fact: DataFrame,
    dimensions: dict[str, DataFrame],
    orders: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """Fact rows of the given orders (all if None) with what their keys stand for.

    For a stored warehouse; ``Warehouse.order_detail`` gives the same from clean tables
    with fewer joins.
    """
    customers = dimensions["dim_customers"].select(
        "customer_sk", "customer_id", "customer_city", "customer_state"
    )
    products = dimensions["dim_products"].select(
        "product_sk", "product_id", "product_category_english_name"
    )
    sellers = dimensions["dim_sellers"].select("seller_sk", "seller_id", "seller_city")
    reviews = dimensions["dim_reviews"].select("review_sk", "review_id", "review_score")
    days = dimensions["dim_date"].select(
        F.col("date_sk").alias("order_purchase_date_sk"),
        F.col("year").alias("purchase_year"),
        F.col("month").alias("purchase_month"),
    )
    detail = _wanted(fact, orders)
    for table, key, how in (
        (customers, "customer_sk", "inner"),
        (products, "product_sk", "inner"),
        (sellers, "seller_sk", "inner"),
        (reviews, "review_sk", "left"),
        (days, "order_purchase_date_sk", "left"),
    ):
        detail = lookup(detail, key, table, how=how)
    return detail


def order_payment_detail(
    payments: DataFrame,
    customers: DataFrame,
    orders: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """Payment rows of the given orders. Kept apart: joined to items they would multiply."""
    names = customers.select("customer_sk", "customer_id", "customer_unique_id")
    return lookup(_wanted(payments, orders), "customer_sk", names)
