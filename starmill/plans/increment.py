"""Loads that follow a load: what is known keeps its keys, what is new is numbered after it.

A batch is a set of clean tables, as for the first load. It must hold the orders that its
items, payments and reviews refer to; customers, sellers and products may be known already.

- Dimensions: a natural key that is loaded keeps its surrogate key and its attributes. Others
  are numbered from the next free key on, in the order of the natural key.
- Dates: loaded days keep their keys. Days between the first and the last day of all loads
  that are missing get the next keys, in order.
- Facts: rows of the batch that are not loaded yet, counted as often as they occur, are
  numbered after the loaded ones. Loaded rows are retired, so that sums count an item once,
  where the batch has other values of their order (status, times, customer), or has a review
  and the row has none. So a batch that changes an order must hold it whole.

So loading the same batch again adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill import schemas
from starmill.functions.calendar import date_attributes, date_spine, join_date_keys
from starmill.operators.matching import keep_matching, lookup
from starmill.plans.model import Warehouse
from starmill.sources.store import Manifest, Part, Store
from starmill.staging import stage

# Columns of a fact that follow from the others, given the date dimension.
DERIVED = ("total_price",)
# Columns of a fact that come from its order, and their names there.
OF_ORDER = {
    "fact_orderlifecycle": {
        c: c
        for c in (
            "customer_sk",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        )
    },
    "fact_orderpayments": {
        "customer_sk": "customer_sk",
        "payment_timestamp": "order_purchase_timestamp",
    },
}


def _stored(table: str) -> list[str]:
    """Columns that tell the rows of a fact apart, copies aside."""
    return [
        c for c in schemas.columns(table)
        if c != schemas.PRIMARY_KEY[table] and not c.endswith("_date_sk") and c not in DERIVED
    ]


@dataclass(frozen=True)
class Increment(Warehouse):
    """The warehouse after a batch. ``loaded`` has the tables before it, ``next_keys`` the next key
    of each. Dimensions are whole; facts are the rows that the batch adds (:meth:`added`)."""

    loaded: Mapping[str, DataFrame] = field(default_factory=dict)
    next_keys: Mapping[str, int] = field(default_factory=dict)

    @cached_property
    def _added(self) -> dict[str, DataFrame]:
        return {}

    def _after(self, table: str, numbered: DataFrame) -> DataFrame:
        key = schemas.PRIMARY_KEY[table]
        return numbered.withColumn(key, F.col(key) + (self.next_keys.get(table, 1) - 1))

    def _dimension_key(self, df: DataFrame, name: str, natural: str) -> DataFrame:
        table = next(t for t, key in schemas.PRIMARY_KEY.items() if key == name)
        before = self.loaded[table].withColumn(name, F.col(name).cast("bigint"))
        fresh = lookup(df, natural, before.select(natural), how="left_anti")
        added = self._after(table, super()._dimension_key(fresh, name, natural))
        self._added[table] = added
        if table == "dim_reviews":
            # Facts need the reviews of the batch, with their orders.
            known = lookup(df, natural, before.select(natural, name))
            return added.unionByName(known.select(*added.columns))
        return added.unionByName(before.select(*added.columns))

    @cached_property
    def dim_reviews(self) -> DataFrame:
        self.reviews
        added = self._added["dim_reviews"].select(*schemas.columns("dim_reviews"))
        return self.loaded["dim_reviews"].select(*added.columns).unionByName(added)

    @cached_property
    def added_dates(self) -> DataFrame:
        """Days of the spine over all loads that have no key yet; at most the calendar's."""
        before = self.loaded["dim_date"]
        skipped = {"both": 0, "right": 1}[self.closed]
        first = before.agg(F.date_sub(F.min("date"), skipped)).scalar()
        last = before.agg(F.max("date")).scalar()
        bounds = self.date_bounds.select(
            F.least("lo", first).alias("lo"), F.greatest("hi", last).alias("hi")
        )
        days = date_spine(bounds, self.closed).select("date")
        new = days.join(F.broadcast(before.select("date")), "date", "left_anti")
        numbered = new.withColumn("date_sk", F.row_number().over(Window.orderBy("date")).cast("bigint"))
        added = date_attributes(self._after("dim_date", numbered))
        return stage(added, "dates", self.folder)

    @cached_property
    def dim_date(self) -> DataFrame:
        added = self.added_dates.select(*schemas.columns("dim_date"))
        return self.loaded["dim_date"].select(*added.columns).unionByName(added)

    def _dated(self, df: DataFrame, days: Mapping[str, str]) -> DataFrame:
        return join_date_keys(df, dict(days), self.dim_date)

    def _unloaded(self, rows: DataFrame, table: str) -> DataFrame:
        """Rows of the batch that the loaded fact does not have, or not as often."""
        columns = _stored(table)
        kinds = dict(rows.dtypes)
        before = keep_matching(self.loaded[table], self.orders, "order_id")
        before = before.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns])
        return rows.select(*columns).exceptAll(before)

    @cached_property
    def fact_orderlifecycle(self) -> DataFrame:
        table = "fact_orderlifecycle"
        fresh = self._unloaded(self.item_rows, table)
        fresh = fresh.withColumn("item_text", F.col("order_item_id").cast("string"))
        return self._after(table, self._number_items(fresh))

    @cached_property
    def fact_orderpayments(self) -> DataFrame:
        table = "fact_orderpayments"
        fresh = self._unloaded(self.order_payments, table)
        fresh = fresh.withColumn("sequential_text", F.col("payment_sequential").cast("string"))
        return self._after(table, self._number_payments(fresh))

    def retired(self, name: str) -> DataFrame | None:
        """Keys of loaded rows that the batch replaces; None for tables that keep all rows."""
        if name not in OF_ORDER:
            return None
        key, same = schemas.PRIMARY_KEY[name], OF_ORDER[name]
        orders = self.orders.select("order_id", *[F.col(o).alias(f"_{c}") for c, o in same.items()])
        changed = reduce(Column.__or__, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same])
        columns = [key, "order_id", *same]
        if name == "fact_orderlifecycle":
            reviewed = self.reviews.select("order_id").distinct().withColumn("_reviewed", F.lit(True))
            orders = orders.join(reviewed, "order_id", "left")
            columns.append("review_sk")
            changed = changed | (F.col("review_sk").isNull() & F.col("_reviewed").isNotNull())
        return lookup(self.loaded[name].select(*columns), "order_id", orders).where(changed).select(key)

    def added(self, name: str) -> DataFrame:
        """The rows of a table that the batch adds."""
        if name == "dim_date":
            return self.added_dates.select(*schemas.columns(name))
        table = self.table(name)  # builds it
        return self._added[name].select(*schemas.columns(name)) if name in self._added else table


def load(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    mode: str = "append",
    names: Sequence[str] = tuple(schemas.TABLES),
    wide_keys: bool = False,
    **options,
) -> Manifest:
    """Load clean ``tables`` into the store at ``root`` and publish the result.

    ``append`` adds what is new; ``overwrite`` starts over. ``names`` restricts the load to
    some tables. ``options`` are those of :class:`Warehouse` and hold for all later loads;
    so does ``wide_keys``, the choice of bigint keys. Numbers beyond INT stop a load
    without it, before anything is published. Staged tables are released in any case.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    store = Store(spark, root)
    last = store.manifest()
    if mode == "append" and last.number:
        wide_keys, options = last.wide_keys, dict(last.options)
        next_keys = {t: p.next_key for t, p in last.tables.items()}
        built: Warehouse = Increment(tables, **options, loaded=store.tables(last), next_keys=next_keys)
    else:
        built = Warehouse(tables, **options)
    try:
        parts = _write(store, built, last if mode == "append" else Manifest(), names, wide_keys)
        manifest = Manifest(last.number + 1, wide_keys, options, parts)
        store.publish(manifest)
    finally:
        built.release()
    return manifest


def _write(
    store: Store, built: Warehouse, last: Manifest, names: Sequence[str], wide_keys: bool
) -> dict[str, Part]:
    name = uuid.uuid4().hex
    built.prepare(names)
    adds = built.added if isinstance(built, Increment) else built.table

    def one(table: str) -> tuple[str, Part]:
        part = last.part(table)
        rows = schemas.conform(adds(table), table, wide_keys)
        folders, count = store.write(rows, table, name)
        part = replace(
            part, folders=part.folders + folders, rows=part.rows + count, next_key=part.next_key + count
        )
        retired = built.retired(table) if isinstance(built, Increment) else None
        if retired is not None:
            folders, count = store.write(retired, table, name, "-retired")
            part = replace(part, retired=part.retired + folders, rows=part.rows - count)
        return table, part

    with ThreadPoolExecutor(len(names)) as pool:
        return dict(last.tables) | dict(pool.map(one, names))
