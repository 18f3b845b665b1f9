"""Existence joins: keep rows with a partner, or report keys without one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, key: str, *tables: DataFrame, how: str = "inner") -> DataFrame:
    """Join ``df`` to each table on ``key`` so that Spark can split a very frequent key.

    Adaptive execution splits an oversized partition only where both inputs come straight
    from a shuffle. A table that was just grouped by the key would be joined without one.
    The key's hash as a second join column asks for a partitioning that no grouping by
    the key has left behind, at the price of shuffling the lookup table once more. Several
    tables share one shuffle of ``df``.
    """

    def marked(side: DataFrame) -> DataFrame:
        return side.withColumn("_hash", F.xxhash64(key))

    joined = marked(df)
    for table in tables:
        joined = joined.join(marked(table), [key, "_hash"], how)
    return joined.drop("_hash")


def keep_matching(
    df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Rows of ``df`` whose key exists in ``parent``; never multiplies rows."""
    wanted = parent.select(F.col(parent_key or key).alias(key))
    return lookup(df, key, wanted, how="left_semi").select(*df.columns)


def orphan_keys(
    df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Distinct keys of ``df`` absent from ``parent``. A NULL key counts as absent.

    ``distinct`` comes first, so the join sees each key once however often it occurs.
    """
    known = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return df.select(key).distinct().join(known, key, "left_anti")


def wanted_orders(df: DataFrame, orders: DataFrame | Sequence[str]) -> DataFrame:
    """Rows of the given orders: ids, or a frame that has them."""
    if isinstance(orders, DataFrame):
        return keep_matching(df, orders, "order_id")
    return df.where(F.col("order_id").isin(*orders))
