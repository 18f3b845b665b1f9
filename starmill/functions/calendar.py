"""Calendar days: bounds, spine, attributes and keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Role-playing dates of an order item: date column -> timestamp column it is taken from.
EVENT_DATES = {
    "order_purchase_date": "order_purchase_timestamp",
    "order_approved_date": "order_approved_at",
    "shipping_limit_day": "shipping_limit_date",
    "delivered_carrier_date": "order_delivered_carrier_date",
    "delivered_customer_date": "order_delivered_customer_date",
    "estimated_delivery_date": "order_estimated_delivery_date",
}


def event_dates(df: DataFrame) -> DataFrame:
    """Add the day of each order event the frame has; the timestamps stay as they are."""
    return df.withColumns(
        {
            day: F.col(moment).try_cast("date")
            for day, moment in EVENT_DATES.items()
            if moment in df.columns
        }
    )


def date_bounds(orders: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """One row (lo, hi): first and last day of purchase, and of further ``columns``."""
    moments = ["order_purchase_timestamp", *columns]

    def day(aggregate, pick):
        values = [aggregate(F.col(c).try_cast("timestamp")) for c in moments]
        return (pick(*values) if len(values) > 1 else values[0]).cast("date")

    return orders.agg(day(F.min, F.least).alias("lo"), day(F.max, F.greatest).alias("hi"))


def _skipped(closed: str) -> int:
    return {"both": 0, "right": 1}[closed]


def date_spine(bounds: DataFrame, closed: str = "both") -> DataFrame:
    """Every day from lo to hi with its position. ``right`` leaves lo itself out.

    The day range is at most the calendar's, about 3.7 million rows.
    """
    first = F.date_add("lo", _skipped(closed))
    # sequence() counts downwards when the first day lies after the last.
    days = bounds.where(first <= F.col("hi")).select(F.posexplode(F.sequence(first, "hi")))
    return days.select((F.col("pos") + 1).alias("date_sk"), F.col("col").alias("date"))


def date_attributes(df: DataFrame, column: str = "date") -> DataFrame:
    """Add day, day_of_week (1 = Sunday), month, year and quarter of a date column."""
    parts = {
        "day": F.dayofmonth,
        "day_of_week": F.dayofweek,
        "month": F.month,
        "year": F.year,
        "quarter": F.quarter,
    }
    return df.withColumns({name: part(column) for name, part in parts.items()})


def date_key(day: Column, lo: Column, hi: Column, closed: str = "both") -> Column:
    """Key of a day in the spine from lo to hi, by arithmetic; NULL outside the spine."""
    position = F.date_diff(day, lo) + 1 - _skipped(closed)
    return F.when((position >= 1) & (day <= hi), position)


def add_date_keys(
    df: DataFrame, days: dict[str, str], bounds: DataFrame, closed: str = "both"
) -> DataFrame:
    """Add a key column per entry of ``days`` (key column -> date column)."""
    span = bounds.select(F.struct("lo", "hi")).scalar()
    lo, hi = F.col("_span.lo"), F.col("_span.hi")
    keys = {sk: date_key(F.col(day), lo, hi, closed) for sk, day in days.items()}
    return df.withColumn("_span", span).withColumns(keys).drop("_span")


def join_date_keys(df: DataFrame, days: dict[str, str], dim_date: DataFrame) -> DataFrame:
    """Same as :func:`add_date_keys`, by joining a date dimension once per role."""

    def attach(frame: DataFrame, role: tuple[str, str]) -> DataFrame:
        sk, day = role
        # A date dimension cannot outgrow the calendar, so it is safe to broadcast.
        lookup = F.broadcast(dim_date.select(F.col("date").alias(day), F.col("date_sk").alias(sk)))
        return frame.join(lookup, day, "left")

    return reduce(attach, days.items(), df)
